"""Spans and words are told apart by their bytes: texts made to collide under
sums of byte values (the Thue-Morse word and the same with its letters
exchanged) go through the operators as any other text."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest

from ledgerlens.llm import byte_bpe, fertility, packing, signature_join
from ledgerlens.llm.textscan import Texts, distinct_spans, units
from ledgerlens.llm.vocabulary import SpanCache
from tests.llm import fixtures as X


def morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


SIZES = (512, 1024, 2048, 8192)


@pytest.fixture(scope="module")
def twins(spark):
    """Ids 2k and 2k + 1: the word of one size and its twin."""
    return list(enumerate(morse(n, letters) for n in SIZES for letters in ("ab", "ba")))


def test_hashes_of_twins_differ(twins):
    words = Texts.of(pa.array([t for _, t in twins])).words()
    assert len(set(words.hashes().tolist())) == len(twins)


def test_packing_of_twins(spark, twins):
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = {i: zlib.crc32(np.array(library.encode(t, add_special_tokens=False).ids + [0], "<u4").tobytes()) for i, t in twins}
    out = packing.pack(X.documents(spark, twins).coalesce(1), path, size=1 << 14, special=True).collect()
    assert {r.doc_id: r.ids_crc32 for r in out} == want


def test_byte_bpe_of_twins(spark):
    import tiktoken
    path = P.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    data = list(enumerate([morse(1024), morse(1024, "ba")] * 2))  # twice, so that they could be in a dictionary
    got = {r.doc_id: (r.n_tokens, r.decoded_sha256)
           for r in byte_bpe.round_trip(X.documents(spark, data).coalesce(1), path, P.PATTERN).collect()}
    assert got == {i: (len(library.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in data}


def test_near_duplicates_of_twins(spark, twins):
    data = [(i, f"{t} a b c d") for i, t in twins]
    assert {r.doc_id: r.component_id for r in signature_join.near_duplicates(X.documents(spark, data)).collect()} == {
        i: i for i, _ in data}


def test_duplicate_lines_of_twins(spark, twins):
    lines = ["x"] + [t for _, t in twins]
    out = fertility.apply_rules(X.documents(spark, [(0, "\n".join(lines)), (1, "\n".join(lines + lines[3:6]))]),
                                P.path("piece_bpe_32k.model")).collect()
    assert {r.doc_id: r.n_dup_lines for r in out} == {0: 0, 1: 3}


def test_distinct_spans_and_cache():
    text = "one two  one\ttwo one" + " x" * 50 + " " + "y" * 200 + " one " + "y" * 200
    texts = Texts.of(pa.array([text, None, "", "one two"]))
    for spans in (units(texts), texts.words()):
        raw = texts.data.tobytes()
        every = [raw[a:b] for a, b in zip(spans.begin.tolist(), spans.end.tolist())]
        first, number, times = distinct_spans(texts.data, spans.begin, spans.end)
        assert [every[f] for f in first[number]] == every and first.tolist() == sorted(first.tolist())
        assert [every.count(every[f]) for f in first] == times.tolist() and len(first) == len(set(every))
        asked = []

        def encode(xs):
            asked.extend(xs)
            return [[ord(c) for c in x] for x in xs]

        cache = SpanCache(encode, limit=1000)
        for _ in range(2):  # long spans are encoded anew, others once
            ids, count = cache.ids(texts.data, spans.begin, spans.end)
            assert bytes(ids.tolist()) == b"".join(every) and count.tolist() == [len(x) for x in every]
        long = {x for x in every if len(x) > 64}
        assert long and len(asked) == len(set(every)) + len(long)
