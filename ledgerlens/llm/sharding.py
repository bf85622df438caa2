"""Uniform shuffle into shards of exact sizes by a hypergeometric matrix.

The counts of rows that go from each partition to each shard are drawn first,
from the multivariate hypergeometric law that a uniform shuffle has.  Each
partition then permutes its rows and deals them out by its row of the matrix;
after the exchange each shard permutes what it got.  Every arrangement of the
rows is equally likely and every shard has exactly its size.

Shards larger than a block are exchanged block by block, a block being a run
of a shard's slots: the matrix has a column per block, so no task ever orders
more than a block or a partition.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common


#: numpy draws from fewer than this.
NUMPY_BELOW = 1_000_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` drawn from ``good + bad`` are good, by inversion: the
    law's values around its mode, from the ratios of neighbours.  Beyond 12
    deviations and 50 there is less than a double resolves."""
    least, most = max(0, n - bad), min(n, good)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), least), most)
    share = good / (good + bad)
    width = int(12 * (n * share * (1 - share) * (good + bad - n) / max(good + bad - 1, 1)) ** 0.5) + 50
    k = np.arange(max(least, mode - width), min(most, mode + width) + 1)
    up = np.log((good - k[:-1]) / (k[:-1] + 1)) + np.log((n - k[:-1]) / (bad - n + k[:-1] + 1))
    weight = np.concatenate(([0.0], np.cumsum(up)))
    upto = np.cumsum(np.exp(weight - weight.max()))
    return int(k[min(np.searchsorted(upto, rng.random() * upto[-1], "right"), len(k) - 1)])


def split(rng: np.random.Generator, left: np.ndarray, n: int, below: int = NUMPY_BELOW) -> np.ndarray:
    """``n`` drawn from columns of ``left``: halves of the columns first, until
    numpy's own draw takes what is there."""
    if n == 0 or len(left) == 1:
        return np.full(len(left), n, np.int64)
    if left.sum() < below:
        return rng.multivariate_hypergeometric(left, n, method="marginals")
    half = len(left) // 2
    good, bad = int(left[:half].sum()), int(left[half:].sum())
    first = hypergeometric(rng, good, bad, n)
    return np.concatenate((split(rng, left[:half], first, below), split(rng, left[half:], n - first, below)))


def communication_matrix(rows: np.ndarray, columns: np.ndarray, seed: int) -> np.ndarray:
    """Counts with these row and column sums, as a uniform shuffle has them."""
    rng = np.random.default_rng(seed)
    left = columns.astype(np.int64).copy()
    out = np.zeros((len(rows), len(columns)), np.int64)
    for i, n in enumerate(rows.tolist()):
        out[i] = split(rng, left, n)
        left -= out[i]
    return out


def blocks(n: int, shards: int, block: int) -> pd.DataFrame:
    """Blocks (column, shard, first, size): shard sizes differ by one at most."""
    rows = []
    for shard in range(shards):
        size = n // shards + (shard < n % shards)
        parts = max(1, -(-size // block))
        first = 0
        for k in range(parts):
            of = size // parts + (k < size % parts)
            rows.append((shard, first, of))
            first += of
    return pd.DataFrame(rows, columns=["shard", "first", "size"])


def shuffle_rows(rows: DataFrame, shards: int, seed: int = 17, block: int = 16_384,
                 max_parts: int = 4_096) -> DataFrame:
    """``rows`` with columns shard and slot: a uniform permutation of all rows
    over ``shards`` whose sizes differ by one at most.

    The rows are written once with the partition they came from, so a retried
    task finds the same rows.  The driver holds the matrix alone: at most
    ``max_parts`` x the number of blocks counts (beyond ``max_parts`` input
    partitions several count as one; ``block`` grows so that there are no more
    blocks than ``max_parts``, or than shards).
    """
    names = rows.columns
    spark = rows.sparkSession
    kept = rows.select(F.struct(*names).alias("_row"), (F.spark_partition_id() % max_parts).alias("_part"),
                       F.monotonically_increasing_id().alias("_at"))
    kept = common.written(kept, "rows")
    counts = kept.groupBy("_part").count().orderBy("_part").toPandas()  # at most max_parts rows
    n = int(counts["count"].sum())
    plan = blocks(n, shards, max(block, -(-n // max_parts)))
    matrix = communication_matrix(counts["count"].to_numpy(np.int64), plan["size"].to_numpy(np.int64), seed)
    share = spark.createDataFrame(
        pd.DataFrame({"_part": counts["_part"].astype("int32"), "counts": [r.tolist() for r in matrix]}),
        "_part int, counts array<long>")
    keys = kept.select("_part", "_at")

    def deal(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        at = np.sort(left["_at"].to_numpy())
        at = np.random.default_rng([seed, 1, int(key[0])]).permutation(at)
        column = np.repeat(np.arange(len(right["counts"].iloc[0])), right["counts"].iloc[0]) if len(right) else at[:0]
        return pd.DataFrame({"_at": at, "_block": column.astype(np.int64)})

    dealt = keys.groupBy("_part").cogroup(share.groupBy("_part")).applyInPandas(deal, "_at long, _block long")
    shard, first = plan["shard"].to_numpy(), plan["first"].to_numpy()

    def settle(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        at = np.sort(pdf["_at"].to_numpy())
        at = np.random.default_rng([seed, 2, int(key[0])]).permutation(at)
        k = int(key[0])
        return pd.DataFrame({"_at": at, "shard": np.full(len(at), shard[k], np.int32),
                             "slot": first[k] + np.arange(len(at), dtype=np.int64)})

    places = dealt.groupBy("_block").applyInPandas(settle, "_at long, shard int, slot long")
    return kept.join(places, "_at").select("_row.*", "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 17, text: str = "text",
                    key: str = "doc_id", **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot,
    grown_shard.

    The law is ``rows``: shard counts are at most one apart, whatever the
    texts; so grown_shard is null.  Null texts count as empty (size 16).
    Repeated rows, equal texts and null ids are rows like any other.  Other
    columns are ignored.  An empty table gives an empty result.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"),
                       (F.octet_length(content) + 16).cast("long").alias("size"),
                       F.crc32(content).cast("long").alias("text_crc32"))
    return shuffle_rows(rows, shards, seed, **how).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
