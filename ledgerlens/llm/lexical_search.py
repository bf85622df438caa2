"""Ranked lexical search by a dual tree.

Texts become vectors over the items' terms, written once.  A task takes them
in chunks, each a tree of documents whose nodes hold the coordinate maxima of
the documents below; the items form a tree of weight maxima, and each node of
it knows the weakest kth score of its items.  A pair of nodes whose product of
maxima is below that score is dropped with all documents and items below it;
what is left at the leaves is scored exactly.  The scores to beat begin with
those of a share of the documents, and rise while a task goes on; whatever they
are, no document among the k best of an item is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.textscan import slices

#: Bytes of a term, A-Z lower-cased; all other bytes are cuts.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256))
LEAF = 16  #: documents of a leaf
CHUNK = 1024  #: documents of a tree, at most
CELLS = 6 << 20  #: of a chunk's matrix, at most (rows times terms), beyond one leaf
SEED_SHARE = 64  #: one document in so many sets the first scores to beat
BLOCK_ITEMS, BLOCK_TERMS = 512, 32_768  #: items searched at once, and their terms with repeats, about
OUT = "item int, item_id long, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM).split()


@dataclass
class Items:
    """A block of items over a vocabulary of their terms."""

    ids: list[int | None]
    vocabulary: dict[bytes, int]
    of: list[np.ndarray]  # each item's distinct terms
    weights: np.ndarray | None = None  # of each term
    n_docs: int = 0  # documents with a term
    n_terms: int = 0  # their terms with repeats
    least: np.ndarray | None = None  # scores to reach, by item
    k: int = 50


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.column(1)):
            ids = batch.column(0).slice(a, b - a).to_pylist()
            texts = batch.column(1).slice(a, b - a).cast(pa.large_binary()).fill_null(b"").to_pylist()
            rows = [(i, t) for i, text in zip(ids, texts) for t in set(terms(text))]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()),
                                              pa.array([t for _, t in rows], pa.binary())], ["item_id", "term"])


def _vectors(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Of each text: its number of terms, the items' terms in it, their counts."""
    size, get = len(vocabulary), vocabulary.get
    for batch in batches:
        for a, b in slices(batch.column(1)):
            texts = batch.column(1).slice(a, b - a).cast(pa.large_binary()).fill_null(b"").to_pylist()
            lengths, known = np.zeros(len(texts), np.int64), []
            for i, text in enumerate(texts):
                found = terms(text)
                lengths[i] = len(found)
                known.append(np.fromiter(map(get, found, repeat(-1)), np.int64, len(found)))
            place = np.concatenate(known)
            owner = np.repeat(np.arange(len(texts)), lengths)[place >= 0]
            cell, times = np.unique(owner * size + place[place >= 0], return_counts=True)
            ends = pa.array(np.searchsorted(cell, np.arange(len(texts) + 1) * size).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(lengths),
                 pa.ListArray.from_arrays(ends, pa.array((cell % size).astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32)))], ["doc_id", "n", "terms", "times"])


def _counts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term; before them, documents and terms in all."""
    total = np.zeros(size + 2, np.int64)
    for batch in batches:
        n = batch.column(0).to_numpy()
        total[0] += np.count_nonzero(n)
        total[1] += n.sum()
        total[2:] += np.bincount(batch.column(1).flatten().to_numpy(), minlength=size)
    place = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], ["place", "total"])


def tree_order(m: np.ndarray, leaf: int) -> np.ndarray:
    """An order of the rows in which near rows stand together: halves, halves
    of halves and so on, each cut at the median of its most varying column."""
    order = np.arange(len(m))
    size = len(m)
    while size > leaf:
        for a in range(0, len(m), size):
            rows = order[a: a + size]
            part = m[rows]
            spread = np.einsum("ij,ij->j", part, part) - part.sum(axis=0) ** 2 / size
            order[a: a + size] = rows[np.argsort(-part[:, int(spread.argmax())], kind="stable")]
        size //= 2
    return order


def levels(m: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Coordinate maxima of the nodes, from the root to the leaves; the number
    of rows is ``leaf`` times a power of two."""
    out = [m.reshape(-1, leaf, m.shape[1]).max(axis=1)]
    while len(out[0]) > 1:
        out.insert(0, out[0].reshape(-1, 2, m.shape[1]).max(axis=1))
    return out


def _padded(n: int, leaf: int) -> int:
    return leaf << max(0, (-(-n // leaf) - 1).bit_length())


class DualTree:
    """The items' tree, and the k best documents of each item so far."""

    def __init__(self, items: Items):
        n = len(items.ids)
        self.items, size = items, _padded(n, 1)
        # Scores are whole numbers; doubles hold them while they are below 2 ** 53.
        most = max(int(items.weights[t].sum()) for t in items.of) * 1_000_000
        self.kind = np.float64 if most < 1 << 53 else np.int64
        m = np.zeros((size, len(items.vocabulary)), self.kind)
        for j, t in enumerate(items.of):
            m[j, t] = items.weights[t]
        self.order = tree_order(m.astype(np.float64), 1)  # node at the last level -> item
        m = m[self.order]
        self.by_level = [level.T.copy() for level in levels(m, 1)]
        self.least = np.full(size, np.iinfo(np.int64).max)
        self.least[:n] = items.least
        self.best = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]  # item, score, doc_id, null

    def add(self, doc_ids: pa.Array, n: np.ndarray, owner: np.ndarray, place: np.ndarray, times: np.ndarray) -> None:
        """A chunk of documents; entry i says that document ``owner[i]`` holds
        term ``place[i]`` so often."""
        items, docs = self.items, len(n)
        wide = 50 * int(n.max()) * items.n_docs >= 1 << 63
        m = (50 + 50 * (n.astype(object) if wide else n) * items.n_docs // items.n_terms).astype(np.int64)[owner]
        value = np.zeros((_padded(docs, LEAF), len(items.vocabulary)), self.kind)
        value[owner, place] = 1_000_000_000 * times // (1000 * times + 20 * m)
        order = tree_order(value * items.weights, LEAF)
        value = value[order]
        nodes = levels(value, LEAF)
        at_least = [self.least[self.order]]
        while len(at_least[0]) > 1:
            at_least.insert(0, at_least[0].reshape(-1, 2).min(axis=1))
        steps = max(len(nodes), len(self.by_level)) - 1
        open_ = np.ones((1, 1), bool)
        for step in range(steps + 1):
            a, b = (round(step * (len(x) - 1) / max(steps, 1)) for x in (nodes, self.by_level))
            open_ = open_.repeat(len(nodes[a]) // open_.shape[0], 0).repeat(len(at_least[b]) // open_.shape[1], 1)
            rows, columns = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
            if not len(rows):
                return
            bound = nodes[a][rows] @ self.by_level[b][:, columns]
            open_[np.ix_(rows, columns)] &= bound >= at_least[b][columns]
        found = []
        for leaf in np.flatnonzero(open_.any(axis=1)).tolist():
            columns = np.flatnonzero(open_[leaf])
            score = value[leaf * LEAF: (leaf + 1) * LEAF] @ self.by_level[-1][:, columns]
            i, j = np.nonzero(score >= at_least[-1][columns])
            found.append((self.order[columns[j]], score[i, j].astype(np.int64), order[leaf * LEAF + i]))
        if found:
            item, score, doc = (np.concatenate(x) for x in zip(*found))
            null = np.asarray(doc_ids.is_null())[doc]
            doc = doc_ids.fill_null(0).to_numpy()[doc]
            self._keep(item, score, doc, null)

    def _keep(self, *more: np.ndarray) -> None:
        item, score, doc, null = (np.concatenate(x) for x in zip(self.best, more))
        order = np.lexsort((doc, null, -score, item))
        first = np.searchsorted(item[order], item[order])
        rank = np.arange(len(order)) - first
        self.best = [x[order[rank < self.items.k]] for x in (item, score, doc, null)]
        last = order[rank == self.items.k - 1]
        self.least[item[last]] = np.maximum(self.least[item[last]], score[last])

    def rows(self) -> pa.RecordBatch:
        item, score, doc, null = self.best
        ids = [self.items.ids[j] for j in item.tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(ids, pa.int64()), pa.array(doc, mask=null), pa.array(score)],
            ["item", "item_id", "doc_id", "score"])


def _search(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
    tree = DualTree(items)
    chunk = max(LEAF, min(CHUNK, CELLS // max(len(items.vocabulary), 1)))
    for batch in batches:
        for a in range(0, batch.num_rows, chunk):
            doc_ids, n, terms_, times = batch.slice(a, chunk).columns
            count = np.asarray(terms_.value_lengths())
            if count.sum():
                tree.add(doc_ids, n.to_numpy(), np.repeat(np.arange(len(count)), count), terms_.flatten().to_numpy(),
                         times.flatten().to_numpy().astype(np.int64))
    yield tree.rows()


def _ranked(vectors: DataFrame, items: Items) -> DataFrame:
    held = common.send(vectors.sparkSession, items)
    k = items.k
    found = vectors.select("doc_id", "n", "terms", "times").mapInArrow(lambda it: _search(it, common.received(held)), OUT)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _block(pairs: DataFrame, k: int) -> Items:
    """A block's items, from (item_id, term) rows on the driver."""
    by: dict[int | None, list[bytes]] = {}
    for row in pairs.toLocalIterator():
        by.setdefault(row["item_id"], []).append(bytes(row["term"]))
    ids = sorted(by, key=lambda i: (i is None, i or 0))
    vocabulary = {t: j for j, t in enumerate(sorted({t for ts in by.values() for t in ts}))}
    return Items(ids, vocabulary, [np.array(sorted(vocabulary[t] for t in by[i])) for i in ids], k=k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, text: str = "text", key: str = "doc_id",
           item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item_id, rank, doc_id, score.

    Items are searched in blocks of about ``BLOCK_ITEMS`` and ``BLOCK_TERMS``,
    one scan of the documents each.  Rows with one item_id are one item
    with all their terms; a null id is one too.  Null and empty texts have
    no terms: as documents they do not count, as items they have no rows.  Every
    row of a repeated doc_id is a document; null ids come last among equal
    scores.  Texts of any length are read whole.  Other columns are ignored;
    empty tables give an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    asked = items.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    pairs = common.written(asked.mapInArrow(_item_terms, "item_id long, term binary").distinct(), "items")
    n_pairs, n_items = pairs.agg(F.count(F.lit(1)), F.count_distinct(F.struct("item_id"))).first()
    blocks = max(-(-n_pairs // BLOCK_TERMS), -(-n_items // BLOCK_ITEMS))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks):
        block = _block(pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b), k)
        if block.ids:
            out = out.unionByName(_searched(texts, block))
    common.drop_written(pairs)
    return out


def _searched(texts: DataFrame, items: Items) -> DataFrame:
    spark, size = texts.sparkSession, len(items.vocabulary)
    words = common.send(spark, items.vocabulary)
    vectors = common.written(texts.mapInArrow(
        lambda it: _vectors(it, common.received(words)), "doc_id long, n long, terms array<int>, times array<int>"), "vectors")
    totals = {row["place"]: row["total"] for row in vectors.select("n", "terms").mapInArrow(
        lambda it: _counts(it, size), "place long, total long").groupBy("place").agg(F.sum("total").alias("total")).collect()}
    items.n_docs, items.n_terms = totals.get(0, 0), totals.get(1, 0)
    holding = np.array([totals.get(2 + t, 0) for t in range(size)])
    items.weights = np.array([math.floor(1000 * math.log((2 * items.n_docs + 2) / (2 * int(df) + 1))) for df in holding], np.int64)
    items.least = np.ones(len(items.ids), np.int64)
    # The kth score among a share of the documents: the least to reach, or one.
    some = vectors.where((F.pmod(F.xxhash64("doc_id"), F.lit(SEED_SHARE)) == 0) & (F.size("terms") > 0))
    for row in _ranked(some, items).where(F.col("rank") == items.k).collect():  # a row an item at most
        items.least[row["item"]] = max(1, row["score"])
    found = common.written(_ranked(vectors.where(F.size("terms") > 0), items)
                           .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "found")
    common.drop_written(vectors)
    return found
