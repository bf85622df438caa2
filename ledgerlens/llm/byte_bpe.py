"""Byte-level BPE: encoding by a fold of ranked merges, decoding by pieces.

Texts are cut into spans at places that the pre-tokenising pattern never
looks across.  A word, a match of the pattern, is an array of bytes, then of
one long a piece; a Spark higher-order function folds the merges over it: the pair of neighbouring
pieces whose merge has the lowest rank, the leftmost first, becomes one piece,
until no pair is in the literal rank map.  Distinct spans are folded, not
occurrences: the most frequent ones, counted over all texts, once into a
dictionary of bounded size; any other where it occurs, once for each slice of
texts.  Decoding looks up each id's bytes in a literal array and joins them.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.textscan import Blocks, Texts, distinct_spans, slices, span_hashes, units

BUCKETS = 1 << 14  #: of the literal rank map, so that a look-up sees a few entries
LEFT = (1 << 20) + 40_503  #: a pair's key is left id * LEFT + right id; odd, so that the low bits, its bucket, depend on both
#: A piece of a word is one long: the rank of its merge with the next piece, its
#: place in the word, its id.  The least of them is the next merge, the leftmost
#: of equal ranks.
RATE, IDS = 43, (1 << 20) - 1
PLACE, PLACES = 1 << 20, ((1 << 23) - 1) << 20  #: a word of 8 MB and more has no place; its fold would take years
NEVER = IDS << RATE  #: the rank of a pair that never merges
BEGIN, END = NEVER + IDS, NEVER + PLACES + IDS  #: around every word: no merge takes them in
BATCH = 4 << 20  #: bytes of an Arrow batch, whose rows are slices of texts
LONGEST = 48  #: bytes of a span in the dictionary
#: Unicode white space, which is what the pattern's \\s means.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def exact_pattern(pattern: str) -> str:
    """``pattern`` with white space spelt out, whatever a library takes for it."""
    return (pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]"))


def rank_map(ranks: dict[bytes, int]) -> Column:
    """A literal: buckets of a pair's key -> rank of the merge, which is also
    the merged piece's id."""
    if max(ranks.values()) >= IDS:
        raise ValueError("the vocabulary has too many ids")
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        for k in range(1, len(piece)):
            a, b = ranks.get(piece[:k]), ranks.get(piece[k:])
            if a is not None and b is not None:
                key = a * LEFT + b
                buckets[key % BUCKETS][str(key)] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>").cast("array<map<bigint,int>>")


def _let(value: Column, body) -> Column:
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, body)


def fold_merges(spans: Column, ranks: dict[bytes, int]) -> Column:
    """Ids of each span: an array of words, each an array of its bytes (0 to 255)."""
    single = F.from_json(F.lit(json.dumps([ranks[bytes([i])] for i in range(256)])), "array<bigint>")

    def all_words(table: Column, byte: Column) -> Column:
        def rate(a: Column, b: Column) -> Column:
            key = a * LEFT + b
            rank = F.get(table, key.bitwiseAND(BUCKETS - 1).cast("int"))[key]
            return F.coalesce(F.shiftleft(rank.cast("long"), RATE), F.lit(NEVER))

        def step(word: Column, _: Column) -> Column:
            def merge(least: Column) -> Column:
                new = F.shiftright(least, RATE)

                def at(p: Column) -> Column:
                    left, taken, right = (F.get(word, p + k) for k in (-2, 0, 1))
                    before = left.bitwiseAND(PLACES | IDS) + rate(left.bitwiseAND(IDS), new)
                    here = least.bitwiseAND(PLACES) + new + rate(new, right.bitwiseAND(IDS))
                    # Every piece is found once, by its place: removing and inserting cost least.
                    rest = F.array_remove(F.array_remove(F.array_remove(word, left), least), taken)
                    return F.array_insert(F.array_insert(rest, p - 1, before), p, here)

                return F.when(least < NEVER, _let(F.array_position(word, least).cast("int"), at)).otherwise(word)

            return _let(F.array_min(word), merge)

        def one(word: Column) -> Column:
            def piece(b: Column, i: Column) -> Column:
                own, other = F.get(byte, b.cast("int")), F.get(byte, F.get(word, i + 1).cast("int"))
                return rate(own, other) + i.cast("long") * PLACE + own

            pieces = F.concat(F.array(F.lit(BEGIN)), F.transform(word, piece), F.array(F.lit(END)))
            return F.aggregate(F.slice(word, F.lit(2), F.size(word)), pieces, step,
                               lambda w: F.transform(F.slice(w, F.lit(2), F.size(w) - 2), lambda x: x.bitwiseAND(IDS).cast("int")))

        return F.transform(spans, lambda words: F.flatten(F.transform(words, one)))

    # Bound once, so that the plan holds the literals once.
    return _let(rank_map(ranks), lambda table: _let(single, lambda byte: all_words(table, byte)))


def _split(spans: list[bytes], match: regex.Pattern) -> pa.Array:
    """The words of each span as byte arrays: list<list<int16>>."""
    words = [[w.encode() for w in match.findall(s.decode("utf-8", "replace"))] for s in spans]
    flat = [w for ws in words for w in ws]
    offsets = lambda sizes: pa.array(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))).astype(np.int32))
    data = np.frombuffer(b"".join(flat), np.uint8).astype(np.int16)
    inner = pa.ListArray.from_arrays(offsets([len(w) for w in flat]), pa.array(data))
    return pa.ListArray.from_arrays(offsets([len(ws) for ws in words]), inner)


def _span_counts(batches: Iterator[pa.RecordBatch], flush: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Rows (span, n) of the distinct spans, about every ``flush`` bytes."""
    held: list[pa.Table] = []
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        total = pa.concat_tables(held).group_by("span").aggregate([("n", "sum")])
        yield from total.select(["span", "n_sum"]).rename_columns(["span", "n"]).to_batches()

    for batch in batches:
        for a, b in slices(batch.column(1)):
            u = units(Texts.of(batch.column(1).slice(a, b - a)))
            first, _, count = distinct_spans(u.texts.data, u.begin, u.end)
            # Spans cover the texts, so their ends are the offsets of a binary array.
            at = np.append(u.begin, len(u.texts.data)).astype(np.int32)
            every = pa.Array.from_buffers(pa.binary(), len(u.begin), [None, pa.py_buffer(at), pa.py_buffer(u.texts.data)])
            held.append(pa.table({"span": every.take(pa.array(first)), "n": count.astype(np.int64)}))
            size += len(u.texts.data)
            if size >= flush:
                yield from out()
                held, size = [], 0
    if held:
        yield from out()
    del held
    pa.default_memory_pool().release_unused()  # the worker goes on to other tasks


def _span_words(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[pa.RecordBatch]:
    match = regex.compile(exact_pattern(pattern))
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), _split(batch.column(0).to_pylist(), match)], ["span", "words"])


@dataclass
class Known:
    """The dictionary: spans in order of their hashes, and their ids."""

    hashes: np.ndarray
    span_at: np.ndarray
    spans: np.ndarray
    at: np.ndarray
    flat: np.ndarray


def dictionary(texts: DataFrame, ranks: dict[bytes, int], pattern: str, limit: int) -> Known:
    """Frequent spans of at most ``LONGEST`` bytes, of at most ``limit`` bytes in all."""
    counted = texts.mapInArrow(_span_counts, "span binary, n long")
    total = common.written(counted.groupBy("span").agg(F.sum("n").alias("n"))
                           .where((F.col("n") > 1) & (F.length("span") <= LONGEST)), "spans")
    # The least class of counts that keeps the dictionary within its limit:
    # every count up to 4,096 is a class, above that 64 to a doubling.
    rate = F.when(F.col("n") <= 4096, F.col("n")).otherwise(4096 + F.floor(64 * F.log2(F.col("n") / 4096))).cast("long")
    by_rate = (total.select(rate.alias("rate"), (4 * F.length("span") + 32).alias("size")).groupBy("rate")
               .agg(F.sum("size").alias("size")).orderBy(F.desc("rate")).collect())  # a few thousand rows
    least, room = 1 << 62, limit
    for row in by_rate:
        if row["size"] > room:
            break
        least, room = row["rate"], room - row["size"]
    words = (total.where(rate >= least).select("span")
             .mapInArrow(lambda it: _span_words(it, pattern), "span binary, words array<array<smallint>>"))
    folded = words.select("span", fold_merges(F.array("words"), ranks)[0].alias("ids")).toArrow().combine_chunks()
    common.drop_written(total)
    kind = np.uint16 if max(ranks.values()) < 1 << 16 else np.uint32
    if not len(folded):
        none = np.zeros(1, np.int32)
        return Known(np.zeros(0, np.uint64), none, np.zeros(0, np.uint8), none, np.zeros(0, kind))
    spans = Texts.of(folded.column(0).chunk(0))
    order = np.argsort(span_hashes(spans.data, spans.at[:-1], spans.at[1:]))
    spans = Texts.of(folded.column(0).chunk(0).take(pa.array(order)))
    ids = folded.column(1).chunk(0).take(pa.array(order))
    return Known(span_hashes(spans.data, spans.at[:-1], spans.at[1:]), spans.at.astype(np.int32), spans.data,
                 np.asarray(ids.offsets).astype(np.int32), np.asarray(ids.flatten()).astype(kind))


def _look_up(batches: Iterator[pa.RecordBatch], pattern: str, hashes: np.ndarray, span_at: np.ndarray,
             spans_: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per slice of texts: doc_ids, spans of each, their slots (the
    dictionary's, or -1 - the place among ``words``), the words of other spans."""
    match = regex.compile(exact_pattern(pattern))
    held = Blocks.of(spans_, span_at[:-1], span_at[1:])
    for batch in batches:
        for a, b in slices(batch.column(1)):
            u = units(Texts.of(batch.column(1).slice(a, b - a)))
            first, inverse, _ = distinct_spans(u.texts.data, u.begin, u.end)
            own = Blocks.of(u.texts.data, u.begin[first], u.end[first])
            slot = np.searchsorted(hashes, own.hashes())
            new = ~own.equal(held, slot)
            slot[new] = -1 - np.arange(int(new.sum()))
            data = u.texts.data.tobytes()
            spans = [data[i:j] for i, j in zip(u.begin[first[new]].tolist(), u.end[first[new]].tolist())]
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            yield pa.RecordBatch.from_arrays(
                [one(batch.column(0).slice(a, b - a)), one(pa.array(np.diff(u.of).astype(np.int32))),
                 one(pa.array(slot[inverse].astype(np.int32))), one(_split(spans, match))],
                ["doc_ids", "spans", "slots", "words"])


def _assemble(batches: Iterator[pa.RecordBatch], at: np.ndarray, flat: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row (doc_id, ids) per text."""
    for batch in batches:
        for k in range(batch.num_rows):
            doc_ids, spans, slots, own = (batch.column(j)[k].values for j in range(4))
            slots = slots.to_numpy().astype(np.int64)
            # One address space: the dictionary's ids, then the slice's own.
            own_at = np.asarray(own.offsets).astype(np.int64) if len(own) else np.zeros(1, np.int64)
            own_flat = np.asarray(own.values) if len(own) else np.zeros(0, np.int32)
            is_own = slots < 0
            source = np.where(is_own, -1 - slots, slots)
            begin, count = np.empty(len(slots), np.int64), np.empty(len(slots), np.int64)
            for mask, offsets, shift in ((~is_own, at, 0), (is_own, own_at, len(flat))):
                begin[mask] = offsets[source[mask]] + shift
                count[mask] = offsets[source[mask] + 1] - offsets[source[mask]]
            total = np.concatenate(([0], np.cumsum(count)))
            where = np.arange(total[-1]) + np.repeat(begin - total[:-1], count)
            ids = np.empty(total[-1], np.int32)
            low = where < len(flat)
            ids[low] = flat[where[low]]
            ids[~low] = own_flat[where[~low] - len(flat)]
            cuts = total[np.concatenate(([0], np.cumsum(spans.to_numpy().astype(np.int64))))]
            for i in range(0, len(doc_ids), 500):
                j = min(i + 500, len(doc_ids))
                part = cuts[i: j + 1]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array((part - part[0]).astype(np.int32)), pa.array(ids[part[0]: part[-1]]))],
                    ["doc_id", "ids"])


def encode(docs: DataFrame, path: str, pattern: str, limit: int = 32 << 20, text: str = "text",
           key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array<int>).

    The dictionary takes at most ``limit`` bytes, spans and ids together, for
    any input; spans beyond it are folded where they occur.  Null and empty
    texts have no ids.  Repeated rows give equal rows; other columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ranks = read_ranks(path)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    texts = common.small_batches(docs.select(F.col(key).cast("long").alias("doc_id"),
                                             F.col(text).cast("string").alias("text")))
    known = dictionary(texts, ranks, pattern, limit)
    # Each kind of task gets its part alone.
    to_find = spark.sparkContext.broadcast((known.hashes, known.span_at, known.spans))
    to_fill = spark.sparkContext.broadcast((known.at, known.flat))
    del known
    pa.default_memory_pool().release_unused()
    rows = texts.mapInArrow(
        lambda it: _look_up(it, pattern, *to_find.value),
        "doc_ids array<long>, spans array<int>, slots array<int>, words array<array<array<smallint>>>")
    rows = rows.select("doc_ids", "spans", "slots", fold_merges(F.col("words"), ranks).alias("ids"))
    return rows.mapInArrow(lambda it: _assemble(it, *to_fill.value), "doc_id long, ids array<int>")


def decode(ids: Column, path: str) -> Column:
    """The bytes that an array of ids stands for."""
    ranks = read_ranks(path)
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))


def round_trip(docs: DataFrame, path: str, pattern: str, **how) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each text."""
    rows = encode(docs, path, pattern, **how)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(decode(F.col("ids"), path), 256).alias("decoded_sha256"))
