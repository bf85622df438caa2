"""Best-fit packing of tokenised texts into sequences of bounded length.

Hierarchical residual packing: pieces are dealt into groups of bounded size,
each group is packed best-fit decreasing, and bins that are nearly full leave.
The others go on as items, whole, into fewer groups, round after round, until
one small group has been packed or a round no longer helps.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.textscan import Texts, slices, units
from ledgerlens.llm.vocabulary import SpanCache, added_tokens, span_cache


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """Places (start, length) of the pieces of ``n`` ids; only the first may be short."""
    first = n % size or size
    return [(0, first), *((s, size) for s in range(first, n, size))]


def _encoded(column: pa.Array, cache: SpanCache) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts in a row, and where each text's begin and end."""
    texts = Texts.of(column)
    spans = units(texts)
    ids, count = cache.ids(texts.data, spans.begin, spans.end)
    return ids, np.concatenate(([0], np.cumsum(count)))[spans.of]


def _encoded_around(column: pa.Array, cache: SpanCache, added: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The same, where the strings of ``added`` are tokens of their own: the
    text is cut at them first, the longest where several begin."""
    if not any(pc.any(pc.match_substring(column, token)).as_py() for token in added):
        return _encoded(column, cache)
    at = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
    cuts = [at.split(text or "") for text in column.to_pylist()]
    ids, total = _encoded(pa.array([part for parts in cuts for part in parts[::2]], column.type), cache)
    out, ends, k = [], [0], 0
    for parts in cuts:
        for i, part in enumerate(parts):
            if i % 2:
                out.append(np.array([added[part]], ids.dtype))
            else:
                out.append(ids[total[k]: total[k + 1]])
                k += 1
        ends.append(ends[-1] + sum(map(len, out[-len(parts):])))
    return np.concatenate(out), np.array(ends)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int,
            with_ids: bool, special: bool) -> Iterator[pa.RecordBatch]:
    cache = span_cache("tokenizers", path)
    added = added_tokens(path) if special else {}
    for batch in batches:
        for a, b in slices(batch.column(1)):
            ids, total = _encoded_around(batch.column(1).slice(a, b - a), cache, added)
            rows: list[tuple] = []
            doc_ids = batch.column(0).slice(a, b - a).to_pylist()
            for doc_id, s, e in zip(doc_ids, total[:-1].tolist(), total[1:].tolist()):
                own = np.append(ids[s:e], end_id).astype("<u4")
                for k, (start, length) in enumerate(cut(len(own), size)):
                    part = own[start: start + length]
                    rows.append((doc_id, k, start, length, zlib.crc32(part.tobytes()),
                                 part.astype(np.int32) if with_ids else None))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                                                          pa.int64(), pa.list_(pa.int32())))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])


def best_fit(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, packed best-fit in decreasing length.

    A bit mask of the free spaces in use finds the tightest bin at once.
    """
    free: list[list[int]] = [[] for _ in range(size + 1)]
    mask, n_bins = 0, 0
    where, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        fitting = mask >> need
        if fitting:
            space = need + (fitting & -fitting).bit_length() - 1
            into = free[space].pop()
            if not free[space]:
                mask ^= 1 << space
        else:
            space, into = size, n_bins
            n_bins += 1
        where[i], offset[i] = into, size - space
        if space > need:
            free[space - need].append(into)
            mask |= 1 << (space - need)
    return where, offset


def _round(size: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item", ignore_index=True)
        where, offset = best_fit(pdf["length"].tolist(), size)
        bins = pdf.assign(bin=where, offset=offset)
        of = bins.groupby("bin")
        return pd.DataFrame({"item": bins["item"], "bin": of["item"].transform("min"),
                             "offset": bins["offset"].astype("int64"), "used": of["length"].transform("sum")})
    return pack


def place(items: DataFrame, size: int, group: int = 4096, slack: int = 16, max_rounds: int = 8,
          least_gain: float = 0.002) -> DataFrame:
    """Place ``items(item, length)`` of at most ``size`` each into sequences:
    one row (item, sequence_id, offset) per item.

    Full items are sequences of their own.  ``group`` bounds the items that
    are packed together; bins with at most ``slack`` free leave after a round;
    rounds end with one group, or when they save less than ``least_gain`` of
    the bins that they got.
    """
    full = items.where(F.col("length") >= size).select("item", F.col("item").alias("sequence_id"),
                                                       F.lit(0).cast("long").alias("offset"))
    now = items.where(F.col("length") < size).select("item", "length")
    n, rounds = now.count(), []
    while n:
        groups = -(-n // group)
        dealt = now.withColumn("g", F.pmod(F.xxhash64("item", F.lit(len(rounds))), F.lit(groups)))
        done = common.written(dealt.groupBy("g").applyInPandas(
            _round(size), "item long, bin long, offset long, used long"), f"round{len(rounds)}")
        rounds.append(done)
        bins = done.where("item = bin")
        left = bins.where(F.col("used") < size - slack).select(F.col("bin").alias("item"), F.col("used").alias("length"))
        n_bins, n_left = bins.count(), left.count()
        if groups == 1 or len(rounds) == max_rounds or n - n_bins < least_gain * n:
            break
        now, n = left, n_left
    placed = full
    if rounds:  # from the last round back: an item lies where its bin lies
        part = rounds[-1].select("item", F.col("bin").alias("sequence_id"), "offset")
        for done in reversed(rounds[:-1]):
            outer = part.select(F.col("item").alias("bin"), "sequence_id", F.col("offset").alias("outer"))
            part = (done.join(outer, "bin", "left")
                    .select("item", F.coalesce("sequence_id", "bin").alias("sequence_id"),
                            (F.col("offset") + F.coalesce("outer", F.lit(0))).alias("offset")))
        placed = full.unionByName(part)
    return placed


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = 0, with_ids: bool = False,
         text: str = "text", key: str = "doc_id", special: bool = False, **how) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset, and the ids themselves if ``with_ids``.

    A text's ids, ended by ``end_id``, are cut only if longer than ``size``.
    Null and empty texts are one piece with the end id alone.  Every row of a
    repeated doc_id, or of a null one, is packed; pieces of repeated rows
    differ in their places.  With ``special``, the strings of the vocabulary's
    added tokens become their ids, as in the library without
    ``encode_special_tokens``.  Other columns are ignored.  An empty table gives
    an empty result.
    """
    texts = common.small_batches(docs.select(F.col(key).cast("long").alias("doc_id"),
                                             F.col(text).cast("string").alias("text")))
    pieces = texts.mapInArrow(
        lambda it: _pieces(it, path, end_id, size, with_ids, special),
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>")
    pieces = common.written(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    placed = place(pieces.select("item", "length"), size, **how)
    out = pieces.join(placed, "item").drop("item")
    return out if with_ids else out.drop("ids")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, of a frame packed ``with_ids``:
    sequence_id and ids.  A sequence holds at most ``size`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
