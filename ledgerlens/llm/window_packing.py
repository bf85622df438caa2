"""Tokenised texts in windows of bounded length, best fit in decreasing length.

A text longer than a window is first cut into full windows; what is left of
each text is one piece.  Pieces are dealt into groups of bounded size and each
group is packed best-fit decreasing: a segment tree over the remaining
capacities finds the tightest open window for a piece.  Windows that stay
open are dealt again as pieces, in ever fewer groups, until one group has been
packed or no two open windows fit together.  Then open windows with more than
``slack`` places free are closed: the emptiest of a group are cut to fill the
fullest, and what stays open meets in the next round; the very last one is cut
into windows of powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.textscan import Texts, pieces, slices
from ledgerlens.llm.vocabulary import span_cache

SLICE = 2 << 20  #: bytes of texts encoded at once, about
FEW_PARTS = 500_000  #: parts of cut pieces that are broadcast; with more, pieces are shuffled to them
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int) -> Iterator[pa.RecordBatch]:
    """Rows of PIECE: the full windows of each text, then what is left."""
    cache = span_cache("words", path)
    for batch in batches:
        for a, b in slices(batch.column(1), SLICE):
            doc_ids = batch.column(0).slice(a, b - a).to_pylist()
            texts = Texts.of(batch.column(1).slice(a, b - a))
            spans = pieces(texts)
            ids, count = cache.ids(spans.texts.data, spans.begin, spans.end)
            cut = np.concatenate(([0], np.cumsum(count)))[spans.of]
            # All texts' ids in a row, each text's followed by the end id.
            own = np.insert(ids, cut[1:], end_id).astype("<u4")
            cut = cut + np.arange(len(cut))
            rows: list[tuple] = []
            for doc_id, s, e in zip(doc_ids, cut[:-1].tolist(), cut[1:].tolist()):
                for at in range(s, e, size):
                    part = own[at: min(at + size, e)].tobytes()
                    rows.append((doc_id, at - s, len(part) // 4, zlib.crc32(part), e - s, part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (*[pa.int64()] * 5, pa.binary()))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])


class OpenWindows:
    """Windows by remaining capacity.  Node i of the tree holds the number of
    windows below it; leaf ``base + c`` those with c places free."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.count = [0] * (2 * self.base)
        self.at: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, window: int, free: int) -> None:
        self.at[free].append(window)
        node = self.base + free
        while node:
            self.count[node] += 1
            node >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out a window with the least capacity of at least ``need``."""
        node = self.base + need
        if not self.count[node]:
            # Up to the first subtree on the right with a window, then down its left edge.
            while node & 1 or not self.count[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.base:
                node <<= 1
                if not self.count[node]:
                    node += 1
        free = node - self.base
        while node:
            self.count[node] -= 1
            node >>= 1
        return self.at[free].pop(), free


def best_fit_decreasing(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """Window and offset of each length."""
    where, offset = [0] * len(lengths), [0] * len(lengths)
    windows, made = OpenWindows(size), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = windows.tightest(lengths[i])
        if found is None:
            found, made = (made, size), made + 1
        where[i], offset[i] = found[0], size - found[1]
        if found[1] > lengths[i]:
            windows.add(found[0], found[1] - lengths[i])
    return where, offset


def pour(used: list[int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Fill the fullest of some windows with the emptiest, which are cut.

    Segments (from window, start, length, into window, offset) of the windows
    that are taken apart; all others end full but one at most.
    """
    order = sorted(range(len(used)), key=lambda i: (-used[i], i))
    segments: list[tuple[int, int, int, int, int]] = []
    first, last, start = 0, len(order) - 1, 0  # ``start``: what the last one has given away
    fill = used[order[0]] if order else 0
    while first < last:
        into, source = order[first], order[last]
        n = min(size - fill, used[source] - start)
        if n:
            segments.append((source, start, n, into, fill))
            start, fill = start + n, fill + n
        if start == used[source]:
            last, start = last - 1, 0
        if fill == size:
            first += 1
            fill = used[order[first]]
    if start:  # the one that gave only a part away keeps the rest, from its beginning
        source = order[last]
        segments.append((source, start, used[source] - start, source, 0))
    return segments


def powers_of_two(used: int) -> list[tuple[int, int]]:
    """(start, length) of parts with lengths that are powers of two."""
    out, start = [], 0
    for bit in range(used.bit_length() - 1, -1, -1):
        if used >> bit & 1:
            out.append((start, 1 << bit))
            start += 1 << bit
    return out


def _dealt(df: DataFrame, groups: int, salt: int) -> DataFrame:
    return df.withColumn("g", F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(groups)))


def _packed_group(size: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item", ignore_index=True)
        where, offset = best_fit_decreasing(pdf["length"].tolist(), size)
        of = pdf.assign(window=where).groupby("window")
        return pd.DataFrame({"item": pdf["item"], "window": of["item"].transform("min"),
                             "offset": pd.Series(offset, dtype="int64"), "used": of["length"].transform("sum")})
    return pack


def _poured_group(size: int):
    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item", ignore_index=True)
        item, used = pdf["item"].tolist(), pdf["length"].tolist()
        segments = pour(used, size)
        held = dict(zip(item, used))
        for source, _, n, into, _ in segments:
            if source != into:
                held[item[source]] -= n
                held[item[into]] += n
        rows = [(item[a], s, n, item[b], o) for a, s, n, b, o in segments]
        rest = [(i, -1, n, i, -1) for i, n in held.items() if 0 < n < size]  # what stays open
        return pd.DataFrame(rows + rest, columns=["item", "from", "length", "window", "offset"]).astype("int64")
    return fill


def _fit(items: DataFrame, size: int, group: int, slack: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of best fit, and the windows (item, length) left open."""
    rounds: list[DataFrame] = []
    now = common.written(items, "open")
    n = now.count()
    while n:
        groups = -(-n // group)
        done = common.written(_dealt(now, groups, len(rounds)).groupBy("g").applyInPandas(
            _packed_group(size), "item long, window long, offset long, used long"), f"fit{len(rounds)}")
        rounds.append(done)
        common.drop_written(now)
        now = common.written(done.where((F.col("item") == F.col("window")) & (F.col("used") < size - slack))
                             .select("item", F.col("used").alias("length")), "open")
        left, least = now.agg(F.count(F.lit(1)), F.min("length")).first()
        # Rounds end with one group, with nothing open, or when hardly a window finds another:
        # those at most ``size - least`` long are all that could take one more.
        fitting = now.where(F.col("length") <= size - least).count() if left else 0
        if groups == 1 or fitting < 2 or left > 0.9 * n:
            break
        n = left
    return rounds, now


def place(items: DataFrame, size: int, group: int = 8192, slack: int = 8) -> DataFrame:
    """Where ``items(item, length)`` of less than ``size`` each go: rows (item,
    from, length, sequence_id, offset), more than one for an item that is cut.
    """
    rounds, still = _fit(items, size, group, slack)
    if not rounds:
        return items.select("item", F.lit(0).cast("long").alias("from"), "length", F.col("item").alias("sequence_id"),
                            F.lit(0).cast("long").alias("offset"))
    # An item lies where its window lies, from the last round back.
    part = rounds[-1].select("item", F.col("window").alias("sequence_id"), "offset")
    for done in reversed(rounds[:-1]):
        outer = part.select(F.col("item").alias("window"), "sequence_id", F.col("offset").alias("outer"))
        part = (done.join(outer, "window", "left")
                .select("item", F.coalesce("sequence_id", "window").alias("sequence_id"),
                        (F.col("offset") + F.coalesce("outer", F.lit(0))).alias("offset")))
    out = items.join(part, "item").select("item", F.lit(0).cast("long").alias("from"), "length", "sequence_id", "offset")
    n, depth = still.count(), 0
    while n:
        groups = -(-n // group)
        if n > 1:
            poured = common.written(_dealt(still, groups, 1000 + depth).groupBy("g").applyInPandas(
                _poured_group(size), "item long, from long, length long, window long, offset long"), f"pour{depth}")
            out = _moved(out, poured.where("offset >= 0"))
            still = poured.where("offset < 0").select("item", "length")
            n, depth = still.count(), depth + 1
        if n == 1:  # the last of all
            row = still.first()
            if row["length"] & (row["length"] - 1):
                last = [(row["item"], s, k, -1 - i, 0) for i, (s, k) in enumerate(powers_of_two(row["length"]))]
                out = _moved(out, out.sparkSession.createDataFrame(last, "item long, from long, length long, window long, offset long"))
            break
    return out


def _moved(out: DataFrame, segments: DataFrame) -> DataFrame:
    """``out`` after windows were cut into ``segments(item, from, length,
    window, offset)``; a window has few, and others stay as they are."""
    s = segments.select(F.col("item").alias("sequence_id"), F.col("from").alias("s_from"),
                        (F.col("from") + F.col("length")).alias("s_to"), "window", F.col("offset").alias("s_offset"))
    joined = out.join(s, "sequence_id", "left")
    low = F.greatest("offset", F.coalesce("s_from", "offset"))
    high = F.least(F.col("offset") + F.col("length"), F.coalesce("s_to", F.col("offset") + F.col("length")))
    return (joined.withColumns({"low": low, "high": high}).where("low < high")
            .select("item", (F.col("from") + F.col("low") - F.col("offset")).alias("from"),
                    (F.col("high") - F.col("low")).alias("length"), F.coalesce("window", "sequence_id").alias("sequence_id"),
                    F.when(F.col("window").isNull(), F.col("offset"))
                    .otherwise(F.col("s_offset") + F.col("low") - F.col("s_from")).alias("offset")))


def ids_crc32(ids: Column) -> Column:
    """Of the little-endian unsigned 32-bit ids in a binary column."""
    return F.crc32(ids)


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = 1, with_ids: bool = False, text: str = "text",
         key: str = "doc_id", group: int = 8192, slack: int = 8) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and the ids themselves (little-endian 32-bit numbers
    in a binary) if ``with_ids``.

    The vocabulary drops white space, so texts are encoded word by word,
    plain words by the pieces that the vocabulary's pattern cuts them into.
    Null and empty texts, and texts of white space, are the end id alone.
    A text of any length is cut into full windows and a rest.  Every row of a
    repeated doc_id, or of a null one, is packed.  Equal lengths go in order of
    their rows.  Other columns are ignored.  An empty table gives an empty
    result.
    """
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    pieces = texts.mapInArrow(lambda it: _pieces(it, path, end_id, size), PIECE)
    pieces = common.written(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    short = pieces.where(F.col("length") < size).select("item", "length")
    placed = common.written(place(short, size, group, slack), "placed")
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    full = pieces.where(F.col("length") >= size).withColumns(
        {"sequence_id": F.col("item"), "offset": F.lit(0).cast("long")})
    # Only pieces that were cut, or all for those who ask, need their ids here.
    at = placed.withColumnRenamed("length", "n")
    kept = pieces if with_ids else pieces.drop("ids")
    whole = kept.join(at, "item").where(F.col("n") == F.col("length"))
    parts = common.written(at.join(short, "item").where(F.col("n") < F.col("length")).drop("length"), "parts")
    few = parts.count() <= FEW_PARTS  # of some 40 bytes each
    cut = pieces.join(F.broadcast(parts) if few else parts, "item")
    cut = (cut.withColumn("ids", F.substring("ids", (4 * F.col("from") + 1).cast("int"), (4 * F.col("n")).cast("int")))
           .withColumns({"start": F.col("start") + F.col("from"), "length": F.col("n"), "ids_crc32": ids_crc32(F.col("ids"))}))
    more = ("ids",) if with_ids else ()
    return (full.select(*columns, *more).unionByName(whole.select(*columns, *more))
            .unionByName(cut.select(*columns, *more)))


def sequences(packed: DataFrame) -> DataFrame:
    """The windows themselves, of a frame packed ``with_ids``: sequence_id and
    ids (binary), at most ``size`` of them."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"]))).alias("hex")) \
        .select("sequence_id", F.unhex("hex").alias("ids"))
