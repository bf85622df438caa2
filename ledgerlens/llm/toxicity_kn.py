"""Toxicity from class-conditional Kneser-Ney bigram models.

One model of words for toxic texts, one for ordinary texts, in three levels:
bigrams of the class; below them words of the class, by the number of texts
that they occur in (continuation counts, the contexts being texts); below
those shared backoff counts, the same for both classes: in how many documents
of the whole corpus a word occurs.  An expression that neither
class has seen gets nearly the same probability from both: there the shared
count is a factor of either and leaves the ratio, so words that no labelled
text of the sample holds are counted together, not one by one.

A text is compared by the mean log-likelihood ratio of its words, and of its
most toxic runs of words, so length does not decide.  A logistic curve, fitted
on labelled rows that the models have not seen, turns these into a score.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.gam_quality import held_out
from ledgerlens.llm.textscan import Texts, slices, windows

RUNS = (1, 4, 16)  #: words in the runs whose best mean ratio is a trait
TRAITS = ("mean", *(f"best{k}" for k in RUNS), "marked", "marked_share", "log_words")
DISCOUNT = 0.9  #: of a word's count of texts
TRIM = np.frombuffer(b".,;:!?\"'()[]{}", np.uint8)


def word_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased hashes of the words, less punctuation at either end, and
    the first word of each text."""
    words = texts.words()
    mark = np.zeros(256, bool)
    mark[TRIM] = True
    begin, end = words.begin.copy(), words.end.copy()
    for _ in range(3):
        open_ = end - begin > 1
        begin += open_ & mark[texts.data[begin]]
        open_ = end - begin > 1
        end -= open_ & mark[texts.data[end - 1]]
    words.begin, words.end = begin, end
    return words.hashes(), words.of


@dataclass
class ClassModel:
    """Absolute discounting over sorted hash tables; bigrams found once only
    feed the backoff (their discount is one)."""

    pairs: np.ndarray  # bigram hashes with a count of two or more
    pair_mass: np.ndarray  # their discounted share of the bigrams that begin alike
    words: np.ndarray  # word hashes
    word_mass: np.ndarray  # discounted share of the class's words
    word_left: float  # what the discounts of words leave to the shared counts
    context: np.ndarray  # by word: what the discounts of its bigrams leave

    @staticmethod
    def look(keys: np.ndarray, values: np.ndarray, at: np.ndarray, missing: float) -> np.ndarray:
        if not len(keys):
            return np.full(len(at), missing)
        k = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
        return np.where(keys[k] == at, values[k], missing)

    def likelihood(self, word: np.ndarray, before: np.ndarray, pair: np.ndarray, shared: np.ndarray) -> np.ndarray:
        unigram = self.look(self.words, self.word_mass, word, 0.0) + self.word_left * shared
        left = self.look(self.words, self.context, before, 1.0)
        return self.look(self.pairs, self.pair_mass, pair, 0.0) + left * unigram


def fit_class(texts: list[tuple[np.ndarray, np.ndarray]]) -> ClassModel:
    """From (word hashes, bigram hashes) of the class's texts; bigram i ends in word i + 1.

    Words and bigrams count once a text, so one text that repeats an
    expression is one context of it.
    """
    none = np.zeros(0, np.uint64)
    if not sum(len(w) for w, _ in texts):
        return ClassModel(none, np.zeros(0), none, np.zeros(0), 1.0, np.zeros(0))
    vocabulary, weight = np.unique(np.concatenate([np.unique(w) for w, _ in texts]), return_counts=True)
    first, pairs = [], []
    for w, p in texts:
        kinds, at = np.unique(p, return_index=True)
        pairs.append(kinds)
        first.append(w[at])
    kinds, at, often = np.unique(np.concatenate(pairs), return_index=True, return_counts=True)
    head = np.searchsorted(vocabulary, np.concatenate(first)[at])
    spent = np.minimum(weight, DISCOUNT)
    # Bigrams: single ones give all of their mass to the backoff.
    total = np.bincount(head, often, minlength=len(vocabulary))
    taken = np.bincount(head, minlength=len(vocabulary))
    context = np.where(total > 0, taken / np.maximum(total, 1), 1.0)
    many = often >= 2
    return ClassModel(kinds[many], (often[many] - 1.0) / total[head[many]], vocabulary,
                      (weight - spent) / weight.sum(), float(spent.sum() / weight.sum()), context)


@dataclass
class Scorer:
    toxic: ClassModel
    ordinary: ClassModel
    shared_words: np.ndarray
    shared_mass: np.ndarray
    shared_rest: float
    weights: np.ndarray | None = None

    def ratios(self, word: np.ndarray, before: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of each word."""
        shared = ClassModel.look(self.shared_words, self.shared_mass, word, self.shared_rest)
        return (np.log(self.toxic.likelihood(word, before, pair, shared))
                - np.log(self.ordinary.likelihood(word, before, pair, shared)))

    def traits(self, hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
        """One row of ``TRAITS`` per text; zeros for a text without words."""
        n = len(of) - 1
        out = np.zeros((n, len(TRAITS)))
        if not len(hashes):
            return out
        before = np.concatenate(([np.uint64(0)], hashes[:-1]))
        pair = np.concatenate(([np.uint64(0)], windows(hashes, 2)))
        start = of[:-1][np.diff(of) > 0]
        before[start], pair[start] = 0, 0
        ratio = self.ratios(hashes, before, pair)
        sums = np.concatenate(([0.0], np.cumsum(ratio)))
        for i, (a, b) in enumerate(zip(of[:-1].tolist(), of[1:].tolist())):
            if b > a:
                best = []
                for k in RUNS:
                    k = min(k, b - a)
                    best.append((sums[a + k: b + 1] - sums[a: b + 1 - k]).max() / k)
                marked = int((ratio[a:b] > 3.0).sum())
                out[i] = ((sums[b] - sums[a]) / (b - a), *best, min(marked, 20), marked / (b - a), np.log1p(b - a))
        return out

    def score(self, traits: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(traits), 0.0)
        z = np.clip(_design(traits) @ self.weights, -30, 30)
        return np.where(traits[:, -1] > 0, 1 / (1 + np.exp(-z)), 0.0)


def _design(traits: np.ndarray) -> np.ndarray:
    return np.column_stack((np.ones(len(traits)), traits, traits[:, 4] * traits[:, -1] / 10))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 60) -> np.ndarray:
    """Newton steps on the ridge-penalised logistic loss."""
    x = _design(x)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * w)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _document_counts(batches: Iterator[pa.RecordBatch], words: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, counts): in how many of the task's texts each of ``words``
    occurs; the last place counts the texts' other distinct words."""
    counts = np.zeros(len(words) + 1, np.int64)
    for batch in batches:
        for a, b in slices(batch.column(1)):
            hashes, of = word_hashes(Texts.of(batch.column(1).slice(a, b - a)))
            k = np.searchsorted(words, hashes)
            known = np.zeros(len(hashes), bool)
            known[k < len(words)] = words[k[k < len(words)]] == hashes[k < len(words)]
            owner = np.repeat(np.arange(len(of) - 1, dtype=np.int64), np.diff(of))
            kinds = np.unique(owner[known] * len(words) + k[known]) if len(words) else np.zeros(0, np.int64)
            counts[:-1] += np.bincount(kinds % max(len(words), 1), minlength=len(words))
            other, by = hashes[~known], owner[~known]
            order = np.lexsort((other, by))
            other, by = other[order], by[order]
            counts[-1] += min(len(other), 1) + int(((other[1:] != other[:-1]) | (by[1:] != by[:-1])).sum())
    at = np.flatnonzero(counts)
    for i in range(0, len(at), 100_000):
        part = at[i: i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], ["word", "n"])


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, bound: int = 2_500,
                   label: str = "toxic", text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted.

    The class models are fitted on at most ``bound`` labelled rows of each
    class, by a hash of their text's id; the shared backoff counts come from
    all documents.  Null and empty texts, and texts without words, score 0.
    Repeated rows get equal scores; a repeated id serves as one training row, the
    first of its texts in their order.  Texts are read whole, however long.
    Without rows of both classes every score is 0; an empty ``docs`` gives an
    empty result.  Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = common.small_batches(docs.select(F.col(key).cast("long").alias("doc_id"),
                                             F.col(text).cast("string").alias("text")))
    y = (labels.where(F.col(label).isNotNull() & ~held_out())
         .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y")))
    chosen = None
    for value in (0, 1):
        part = y.where(F.col("y") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 x bound texts; of a repeated id the first in their order.
    sample = texts.join(chosen, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).toPandas()
    sample = sample.sort_values("doc_id", ignore_index=True)
    scorer = fit(sample, texts)
    sent = common.send(spark, scorer)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(sent.value)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                hashes, of = word_hashes(Texts.of(batch.column(1).slice(a, b - a)))
                score = model.score(model.traits(hashes, of))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(score)], ["doc_id", "score"])

    return texts.mapInArrow(scored, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def fit(sample: pd.DataFrame, texts: DataFrame, folds: int = 3) -> Scorer:
    """Class models on ``sample(doc_id, text, y)``, shared counts over ``texts``.

    The logistic curve is fitted on ratios that models of the other folds give.
    """
    parts = []
    for x in sample["text"].fillna("").tolist():
        hashes, _ = word_hashes(Texts.of(pa.array([x])))
        parts.append((hashes, windows(hashes, 2)))
    y = sample["y"].to_numpy(int) if len(sample) else np.zeros(0, int)
    words = np.unique(np.concatenate([w for w, _ in parts] or [np.zeros(0, np.uint64)]))
    held = texts.sparkSession.sparkContext.broadcast(words)
    counts = np.zeros(len(words) + 1, np.int64)
    # One row for each word of the sample, whatever the corpus.
    for row in (texts.mapInArrow(lambda it: _document_counts(it, held.value), "word long, n long")
                .groupBy("word").agg(F.sum("n").alias("n")).toArrow().to_batches()):
        counts[row.column(0).to_numpy()] = row.column(1).to_numpy()
    total = counts.sum() + len(words) + 1
    mass = (counts[:-1] + 1) / total
    rest = float(np.median(mass)) if len(mass) else 1.0

    def scorer(use: np.ndarray) -> Scorer:
        return Scorer(*(fit_class([p for p, keep, v in zip(parts, use, y) if keep and v == c]) for c in (1, 0)),
                      words, mass, rest)

    whole = scorer(np.ones(len(y), bool))
    if len(set(y.tolist())) < 2:
        return whole
    fold = np.arange(len(y)) % folds
    traits = np.zeros((len(y), len(TRAITS)))
    for k in range(folds):
        other = scorer(fold != k)
        for i in np.flatnonzero(fold == k):
            w = parts[i][0]
            traits[i] = other.traits(w, np.array([0, len(w)]))[0]
    whole.weights = fit_logistic(traits, y)
    return whole
