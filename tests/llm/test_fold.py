"""The fold of merges against the library."""

import random

import tiktoken
from pyspark.sql import functions as F

import public_tokenizers as P
from ledgerlens.llm import byte_bpe


def _folded(spark, words, ranks):
    df = spark.createDataFrame([(i, [[list(w)]]) for i, w in enumerate(words)], "i int, words array<array<array<smallint>>>")
    return {r.i: r.ids[0] for r in df.select("i", byte_bpe.fold_merges(F.col("words"), ranks).alias("ids")).collect()}


def test_fold_equals_the_library(spark):
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(3)
    words = [b"", b"a", b" " * 9, "ß€".encode(), b"\xff\x00\xfe", *[b"a" * i + b"b" * j for i in range(9) for j in range(9)],
             *[bytes(draw.choice(b"aeinrst ") for _ in range(draw.randint(1, 40))) for _ in range(500)],
             *[bytes(draw.randrange(256) for _ in range(draw.randint(1, 30))) for _ in range(100)]]
    got = _folded(spark, words, ranks)
    for i, word in enumerate(words):
        assert got[i] == (library._encode_single_piece(word) if word else []), word


def test_leftmost_of_equal_ranks(spark):
    # "aaa" comes from a + aa and from aa + a: of two such pairs the first merges.
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"aaa": 257}
    got = _folded(spark, [b"aaaaa", b"aaaaaa", b"baaaab"], ranks)
    assert got == {0: [256, 257], 1: [256, 256, 256], 2: [98, 256, 256, 98]}


def test_step_copies_no_slices(spark):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256}
    df = spark.createDataFrame([([[[97]]],)], "words array<array<array<smallint>>>")
    plan = df.select(byte_bpe.fold_merges(F.col("words"), ranks).alias("ids"))._jdf.queryExecution().analyzed().toString()
    # Before the first step and after the last one, not in each.
    assert plan.count("slice(") == 2 and plan.count("concat(") == 1
