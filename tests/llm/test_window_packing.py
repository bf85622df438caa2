"""Window packing against the tokenizers library and plain best fit."""

import itertools
import random
import zlib

import public_tokenizers as P
import pytest

from ledgerlens.llm import queries as Q
from ledgerlens.llm import window_packing as W
from tests.llm import fixtures as X

PATH = P.path("word_bpe_49k.json")
ODD = ["a <|endoftext|> b", "<|endoftext|><|startoftext|>x<|endoftext|>", "ΑΣ ΣΑΣ.'S it's IT'S don'T", "é ́x ạ́b",
       "a b c\x1cd\x85e​ f", "İstanbul ẞ ﬁ", "x" * 5000, "𝔸𝕓 👩‍👩‍👧", "a\x00b \x0b c\x0cd",
       "'s 's''s 've'", "1234 5 ½ Ⅷ x²", None, "", " \n\t"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def check(rows, ids, size, whole=True):
    """Every id in exactly one piece, sequences gapless, digests right; the padding."""
    by = {}
    for r in rows:
        part = ids[r.doc_id][r.start: r.start + r.length]
        assert len(part) == r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
        by.setdefault(r.doc_id, []).append((r.start, r.length))
    assert by.keys() == ids.keys()
    for i, parts in by.items():
        parts.sort()
        assert [s for s, _ in parts] == [0, *itertools.accumulate(n for _, n in parts)][:-1]
        assert sum(n for _, n in parts) == len(ids[i])
    full = {}
    for r in rows:
        full.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for parts in full.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *itertools.accumulate(n for _, n in parts)][:-1]
        used = sum(n for _, n in parts)
        assert used <= size
        padding += 0 if used & (used - 1) == 0 else size - used
    return padding


def test_packing_holds_every_id(spark, library, tmp_path):
    data = X.rows()
    data += [(1000 + i, t) for i, t in enumerate(ODD)]
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in data}
    docs = X.documents(spark, data).repartition(5)
    total = sum(map(len, ids.values()))
    for size, group, slack in ((512, 16, 8), (512, 8192, 0), (64, 8, 0)):  # tiny groups: several rounds and pours
        rows = W.pack(docs, PATH, size=size, group=group, slack=slack, with_ids=True).collect()
        padding = check(rows, ids, size)
        assert padding <= slack * (total / size + 20)
        assert all(bytes(r.ids) == b"".join(x.to_bytes(4, "little") for x in ids[r.doc_id][r.start: r.start + r.length])
                   for r in rows)
    packed = W.pack(docs, PATH, size=512, with_ids=True)
    assert sum(len(r.ids) for r in W.sequences(packed).collect()) == 4 * total
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert check(Q.op12_window_packing(spark, str(tmp_path)).collect(), ids, 2048) <= 8 * total / 2048


def test_only_overlong_texts_and_fillers_are_cut(spark):
    rnd = random.Random(2)
    data = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 500)))) for i in range(2000)]
    rows = W.pack(X.documents(spark, data), PATH, size=256, group=300).collect()
    whole = 0
    for _, parts in itertools.groupby(sorted(rows, key=lambda r: (r.doc_id, r.start)), key=lambda r: r.doc_id):
        lengths = [p.length for p in parts]
        whole += lengths == [256] * (len(lengths) - 1) + [sum(lengths) - 256 * (len(lengths) - 1)]
    assert whole > 0.98 * len(data)


def test_lengths_that_never_fit_together(spark):
    """Lengths just over half a window, and a third of all rows of one length."""
    data = [(i, "a " * (130 if i % 3 else 200)) for i in range(600)]
    ids = {i: [0] * (131 if i % 3 else 201) for i, _ in data}
    rows = W.pack(X.documents(spark, data), PATH, size=256, group=64, slack=0).collect()
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert all(n & (n - 1) == 0 for n in used.values()) and sum(used.values()) == sum(map(len, ids.values()))
    assert sum(n < 256 for n in used.values()) <= 8


def test_odd_tables(spark):
    assert W.pack(X.documents(spark, []), PATH).count() == 0
    rows = W.pack(X.documents(spark, [(1, "a b"), (1, "a b"), (None, "a"), (None, None)]), PATH).collect()
    assert sorted(r.length for r in rows) == [1, 2, 3, 3]
    one = W.pack(X.documents(spark, [(1, "a " * 700)]), PATH).collect()
    assert sum(r.length for r in one) == 701 and all(r.length & (r.length - 1) == 0 for r in one)


def test_segment_tree_is_best_fit():
    rnd = random.Random(4)
    for _ in range(50):
        size = rnd.choice((7, 8, 100, 2048))
        lengths = [rnd.randint(1, size) for _ in range(rnd.randint(0, 120))]
        where, offset = W.best_fit_decreasing(lengths, size)
        free, want = [], {}  # plain best fit: the tightest window by a scan
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fitting = [f for f in free if f >= lengths[i]]
            take = min(fitting, default=size)
            if fitting:
                free.remove(take)
            free.append(take - lengths[i])
            want[i] = size - take
        assert [want[i] for i in range(len(lengths))] == offset
        used = {}
        for w, n in zip(where, lengths):
            used[w] = used.get(w, 0) + n
        assert sorted(size - u for u in used.values()) == sorted(free)


def test_pour_keeps_everything():
    rnd = random.Random(6)
    for _ in range(100):
        size = rnd.choice((8, 50, 2048))
        used = [rnd.randint(1, size - 1) for _ in range(rnd.randint(0, 40))]
        segments = W.pour(used, size)
        gone = {}
        for a, s, n, _, _ in segments:
            gone.setdefault(a, []).append((s, n))
        for a, parts in gone.items():
            assert [s for s, _ in parts] == [0, *itertools.accumulate(n for _, n in parts)][:-1]
            assert sum(n for _, n in parts) == used[a]
        held = {i: [(0, n)] for i, n in enumerate(used) if i not in gone}
        for _, _, n, b, o in segments:
            held.setdefault(b, []).append((o, n))
        open_ = 0
        for parts in held.values():
            parts.sort()
            assert [o for o, _ in parts] == [0, *itertools.accumulate(n for _, n in parts)][:-1]
            open_ += sum(n for _, n in parts) < size
        assert open_ <= 1 and sum(n for parts in held.values() for _, n in parts) == sum(used)
