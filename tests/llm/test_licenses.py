"""The licence scan: notices of all families, partial texts, and alignments
held against the whole quadratic table."""

import random

import numpy as np
import pyarrow as pa

from ledgerlens.llm import license_scan as L
from ledgerlens.llm.textscan import Texts
from tests.llm import fixtures as X


def words(text):
    return L.normalised(Texts.of(pa.array([text])))[1]


def quadratic(text, template):
    """Best local alignment score without a band."""
    table = np.zeros((len(text) + 1, len(template) + 1), int)
    for i, a in enumerate(text, 1):
        for j, b in enumerate(template, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if a == b else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
    end = np.unravel_index(table.argmax(), table.shape)
    return int(table.max()), int(end[0])


def test_every_template_is_found_in_prose(spark):
    rnd = random.Random(5)
    data = [(i, f"{X.prose(rnd, 30)} {t} {X.prose(rnd, 30)}") for i, t in enumerate(L.TEMPLATES.values())]
    got = {r.doc_id: r for r in L.scan(X.documents(spark, data)).collect()}
    names = list(L.TEMPLATES)
    assert {names[i] for i, r in got.items() if r.license == names[i]} == set(names)
    assert all(r.coverage == 1.0 for r in got.values())


def test_notice_lines_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lines = ("This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License.",
             "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.")
    want = sorted((r.doc_id, line) for r in docs.collect() for line in lines for _ in range(r.text.split("\n").count(line)))
    found = [r for r in L.scan(docs).collect() if r.coverage == 1.0]
    got = sorted((r.doc_id, r.matched_text + ".") for r in found if r.matched_text + "." in lines)
    assert len(want) > 200 and not set(want) - set(got)
    assert {r.license for r in found if "BY-NC" in r.matched_text} == {"CC-BY-NC-4.0-short"}


def test_part_of_a_long_licence_is_reported(spark):
    text = L.TEMPLATES["MIT-text"].split()
    rnd = random.Random(2)
    data = [(0, X.prose(rnd, 40) + " " + " ".join(text[60:120]) + " " + X.prose(rnd, 40)), (1, " ".join(text[60:75]))]
    got = L.scan(X.documents(spark, data), templates={"MIT-text": L.TEMPLATES["MIT-text"]}).collect()
    assert [r.doc_id for r in got] == [0] and got[0].matched_words == 60
    assert abs(got[0].coverage - 60 / len(text)) < 1e-9 and got[0].matched_text.split()[0].strip("(") == text[60].strip("(")


def test_band_finds_what_the_whole_table_finds():
    rnd = random.Random(9)
    for name in ("MIT-text", "Apache-2.0-notice", "ISC-text", "GPL-header"):
        template = words(L.TEMPLATES[name])
        for _ in range(6):
            changed = L.TEMPLATES[name].split()
            for _ in range(rnd.randint(0, 4)):
                at = rnd.randrange(len(changed))
                changed[at: at + rnd.randint(0, 1)] = [f"word{rnd.random()}"] * rnd.randint(0, 1)
            before = rnd.randint(0, 25)
            text = words(" ".join([X.prose(rnd, before + 1), *changed, X.prose(rnd, 20)]))
            score, end = quadratic(text, template)
            matched, first, stop, own = L.align(text, template, before + 1, 4)
            assert own == score and stop == end
            index = L.Index.of({name: L.TEMPLATES[name]}, 3, 2)
            (found,) = L.find(text, index, 4, 0.5, 10**9)
            assert found == (0, first, stop, matched)
