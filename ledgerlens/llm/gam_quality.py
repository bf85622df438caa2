"""Quality classifier: a generalised additive model with pairwise interactions.

Numeric traits of each whole text are binned at the training rows' quantiles.
Shallow trees are boosted cyclically, one feature after the other, on the
logistic loss; a feature's trees add up to one lookup table over its bins.
The feature pairs whose joint bins explain most of what is left get tables of
their own in the same way.  A score is the logistic of a sum of table entries.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.textscan import Texts, base_counts, per_text, repeats, slices

FEATURES = (
    "log_words", "word_length", "symbol_share", "dup_line_share", "repeat_word_share", "distinct_word_share",
    "upper_share", "digit_share", "bang_share", "pipe_share", "comma_share", "stop_share", "accent_share",
    "shout_word_share", "symbol_word_share", "line_words", "other_share", "short_word_share",
)


def _is(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER = _is(bytes(range(65, 91)))
_LOWER = _is(bytes(range(97, 123)))
_DIGIT = _is(b"0123456789")
_BANG = _is(b"!?")
_PIPE = _is(b"|")
_COMMA = _is(b",;:")
_STOP = _is(b".")
_SYMBOL = _is(b"#*$%&|<>")
_OTHER = _is(b"\"'()[]{}@=+/\\^_`~-" + bytes(range(0, 9)) + bytes(range(14, 32)))


def traits(texts: Texts) -> np.ndarray:
    """One row of ``FEATURES`` per text; zeros where there is nothing to divide."""
    words = texts.words()
    hashes = words.hashes(lower=False)
    base = base_counts(texts, words, hashes)
    data, n = texts.data, len(texts.at) - 1
    owner = words.text_of()
    n_words, chars = base["n_words"], base["word_chars"]
    word = lambda mask: np.bincount(owner[mask], minlength=n)
    share = lambda part, whole: part / np.maximum(whole, 1)
    of = lambda table: share(per_text(texts, np.flatnonzero(table[data])), chars)
    size = words.end - words.begin

    def inside(table: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(table[data])))
        return total[words.end] - total[words.begin]

    _, first = repeats(owner, hashes)
    upper, lower = inside(_UPPER), inside(_LOWER)
    columns = {
        "log_words": np.log1p(n_words), "word_length": share(chars, n_words),
        "symbol_share": share(base["n_symbols"], chars),
        "dup_line_share": share(base["n_dup_lines"], base["n_lines"]),
        "repeat_word_share": share(base["n_repeat_words"], n_words),
        "distinct_word_share": share(word(first), n_words),
        "upper_share": of(_UPPER), "digit_share": of(_DIGIT), "bang_share": of(_BANG), "pipe_share": of(_PIPE),
        "comma_share": of(_COMMA), "stop_share": of(_STOP),
        "accent_share": share(per_text(texts, np.flatnonzero(data >= 0xC0)), chars),
        "shout_word_share": share(word((upper >= 2) & (lower == 0)), n_words),
        "symbol_word_share": share(word(inside(_SYMBOL) > 0), n_words),
        "line_words": share(n_words, base["n_lines"]), "other_share": of(_OTHER),
        "short_word_share": share(word(size <= 3), n_words),
    }
    return np.column_stack([columns[c] for c in FEATURES]).astype(np.float64)


def _trait_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.column(1)):
            x = traits(Texts.of(batch.column(1).slice(a, b - a)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), *map(pa.array, x.T)], ["doc_id", *FEATURES])


@dataclass
class Additive:
    """Lookup tables over bins: one per feature, one per chosen pair."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(edges, x[:, j], side="right")]
        for i, j, table in self.pairs:
            out += table[np.searchsorted(self.coarse[i], x[:, i], side="right"),
                         np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, depth: int, l2: float, least: float) -> np.ndarray:
    """Leaf values, by bin, of a greedy tree on the bins' gradient sums."""
    out = np.full(len(g), -g.sum() / (h.sum() + l2))
    if depth and len(g) > 1:
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gr, hr = g.sum() - gl, h.sum() - hl
        gain = gl**2 / (hl + l2) + gr**2 / (hr + l2)
        gain[(hl < least) | (hr < least)] = -np.inf
        k = int(np.argmax(gain))
        if gain[k] > g.sum()**2 / (h.sum() + l2) + 1e-12:
            out[: k + 1] = _tree(g[: k + 1], h[: k + 1], depth - 1, l2, least)
            out[k + 1:] = _tree(g[k + 1:], h[k + 1:], depth - 1, l2, least)
    return out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 150, pair_rounds: int = 60,
        n_pairs: int = 8, rate: float = 0.1, l2: float = 1.0, least: float = 1.0) -> Additive:
    """Fit on traits ``x`` and 0/1 labels ``y`` (fractions for split votes).

    No rows: every score is one half.  One class only: scores near that class.
    """
    model = Additive()
    if not len(y):
        return model
    n = len(y)
    p0 = (y.sum() + 0.5) / (n + 1)
    model.base = float(np.log(p0 / (1 - p0)))
    quantiles = lambda column, k: np.unique(np.quantile(column, np.linspace(0, 1, k + 1)[1:-1], method="higher"))
    model.edges = [quantiles(c, bins) for c in x.T]
    model.coarse = [quantiles(c, 8) for c in x.T]
    at = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    margin = np.full(n, model.base)

    def slopes(place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return (np.bincount(place, p - y, minlength=size), np.bincount(place, p * (1 - p), minlength=size))

    for _ in range(rounds):
        for j, place in enumerate(at):
            step = rate * _tree(*slopes(place, len(model.tables[j])), 2, l2, least)
            model.tables[j] += step
            margin += step[place]
    # The pairs that explain most of the remaining gradient.
    rough = [np.searchsorted(e, c, side="right") for e, c in zip(model.coarse, x.T)]
    gains = []
    for i in range(x.shape[1]):
        for j in range(i):
            width = len(model.coarse[j]) + 1
            g, h = slopes(rough[i] * width + rough[j], (len(model.coarse[i]) + 1) * width)
            gains.append((float((g**2 / (h + l2)).sum()), i, j))
    chosen = sorted(gains, reverse=True)[:n_pairs]
    tables = {(i, j): np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for _, i, j in chosen}
    for _ in range(pair_rounds):
        for (i, j), table in tables.items():
            place = rough[i] * table.shape[1] + rough[j]
            g, h = (s.reshape(table.shape) for s in slopes(place, table.size))
            # A tree of depth two: the best cut of one axis, then one of the other in each half.
            rows = _tree(g.sum(1), h.sum(1), 1, l2, least)
            step = np.zeros_like(table)
            for value in np.unique(rows):
                part = rows == value
                step[part] = _tree(g[part].sum(0), h[part].sum(0), 1, l2, least)
            table += rate * step
            margin += rate * step.reshape(-1)[place]
    model.pairs = [(i, j, t) for (i, j), t in tables.items()]
    return model


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels may not be learnt from; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 4 == 2


def training_rows(rows: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """At most ``bound`` labelled rows that are not held out, by a hash of
    their id, with ``y`` the mean of the id's labels."""
    y = (labels.where(F.col(label).isNotNull() & ~held_out())
         .groupBy("doc_id").agg(F.avg(F.col(label).cast("double")).alias("y")))
    some = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return rows.join(some, "doc_id")


def trait_table(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and the traits of every row, written once."""
    texts = common.small_batches(docs.select(F.col(key).cast("long").alias("doc_id"),
                                             F.col(text).cast("string").alias("text")))
    schema = "doc_id long, " + ", ".join(f"{c} double" for c in FEATURES)
    return common.written(texts.mapInArrow(_trait_rows, schema), "traits")


def train(rows: DataFrame, labels: DataFrame, label: str = "quality", bound: int = 30_000) -> Additive:
    """Fit on the traits of at most ``bound`` labelled ids: numbers only."""
    some = training_rows(rows, labels, label, bound)
    # One row an id: that with the least traits, should an id have several.
    some = some.groupBy("doc_id", "y").agg(F.min(F.struct(*FEATURES)).alias("row")).select("doc_id", "y", "row.*")
    sample = some.toPandas().sort_values(["doc_id", *FEATURES])
    return fit(sample[list(FEATURES)].to_numpy(float), sample["y"].to_numpy(float))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, bound: int = 30_000,
              label: str = "quality", text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``threshold``
    or more.  Rows are filtered as they stream by, without a shuffle.

    Null and empty texts are scored by their all-zero traits; repeated rows stay
    or go together.  Without labels every score is 0.5.  An empty table stays
    empty; columns of any name stay as they are."""
    sent = common.send(docs.sparkSession, train(trait_table(docs, text, key), labels, label, bound))
    at = docs.columns.index(text)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(sent.value)
        for batch in batches:
            for a, b in slices(batch.column(at)):
                score = model.score(traits(Texts.of(batch.column(at).slice(a, b - a))))
                yield batch.slice(a, b - a).filter(pa.array(score >= threshold))

    return common.small_batches(docs).mapInArrow(good, docs.schema)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, bound: int = 30_000,
                  label: str = "quality", text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted.

    Learns from at most ``bound`` labelled ids.  Null and empty texts have
    all-zero traits and are scored like any other.  Repeated rows get equal
    scores; a repeated id serves as one training row.  Texts are read whole,
    however long.  An empty label table gives 0.5 everywhere; an empty ``docs`` an empty result.  Other
    columns are ignored.
    """
    rows = trait_table(docs, text, key)
    sent = common.send(docs.sparkSession, train(rows, labels, label, bound))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = pickle.loads(sent.value)
        for pdf in batches:
            score = model.score(pdf[list(FEATURES)].to_numpy(float))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": score})

    return (rows.mapInPandas(scored, "doc_id long, score double")
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
