"""Quality rules from public vocabularies: tokeniser fertility.

Base rules count words, symbols and repeats.  The method's own rules measure
how a vocabulary splits a text: characters per token, the share of tokens that
are single bytes (byte fallback), and the entropy of the tokens, in bits.  A
text is kept when each lies inside the band of its language or, where the
language has none, of its script.  Given a quantile, a language's least
characters per token and least entropy come from the texts themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ledgerlens.llm import common
from ledgerlens.llm.textscan import Texts, base_counts, per_text, slices
from ledgerlens.llm.vocabulary import span_cache


@dataclass(frozen=True)
class Band:
    """Limits of a kept text; ``least_entropy`` in bits a token."""

    least_chars: float
    most_chars: float
    most_fallback: float
    least_entropy: float


#: By language or script.  Alphabets that the vocabulary hardly covers fall back to bytes often.
BANDS = {
    "latin": Band(1.4, 9.0, 0.10, 5.0),
    "cyrillic": Band(1.2, 9.0, 0.30, 4.5),
    "greek": Band(0.8, 9.0, 0.60, 4.0),
    "arabic": Band(0.6, 9.0, 0.70, 4.0),
    "cjk": Band(0.3, 6.0, 0.95, 4.0),
    "other": Band(0.25, 12.0, 1.0, 3.0),
}

SCRIPTS = ("latin", "cyrillic", "greek", "arabic", "cjk", "other")


def _script_of_lead() -> np.ndarray:
    """The script that a character's first byte suggests; -1: no letter."""
    out = np.full(256, -1, np.int8)
    out[65:91] = out[97:123] = 0
    out[0xC3:0xCA] = 0
    out[0xCE:0xD0] = 2
    out[0xD0:0xD4] = 1
    out[0xD8:0xDC] = 3
    out[0xE3:0xEE] = 4
    out[0xE0] = out[0xE1] = 5
    out[0xD4:0xD8] = 5
    out[0xDC:0xE0] = 5
    return out


_SCRIPT = _script_of_lead()


def entropy(owner: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Bits per token of each owner's token counts."""
    pair, count = np.unique(owner.astype(np.int64) << 32 | ids.astype(np.int64), return_counts=True)
    who = pair >> 32
    total = np.bincount(who, count, minlength=n)
    share = count / total[who]
    return np.bincount(who, -share * np.log2(share), minlength=n) + 0.0


def _measure(batches: Iterator[pa.RecordBatch], kind: str, path: str, byte_ids: frozenset[int],
             bands: dict[str, Band], least_words: int, most_repeat: int) -> Iterator[pa.RecordBatch]:
    is_byte = np.zeros(max(byte_ids, default=0) + 2, bool)
    is_byte[list(byte_ids)] = True
    cache = span_cache(kind, path)
    for batch in batches:
        for a, b in slices(batch.column(1)):
            texts = Texts.of(batch.column(1).slice(a, b - a))
            n = b - a
            words = texts.words()
            base = base_counts(texts, words, words.hashes(lower=False))
            ids, count = cache.ids(texts.data, words.begin, words.end)
            owner = np.repeat(words.text_of(), count)
            n_tokens = np.bincount(owner, minlength=n)
            n_bytes = np.bincount(owner[is_byte[np.minimum(ids, len(is_byte) - 1)]], minlength=n)
            bits = entropy(owner, ids, n)
            chars = base["word_chars"] / np.maximum(n_tokens, 1)
            fallback = n_bytes / np.maximum(n_tokens, 1)
            leads = _SCRIPT[texts.data]
            letters = np.array([per_text(texts, np.flatnonzero(leads == k)) for k in range(len(SCRIPTS))])
            script = np.where(letters.sum(0) > 0, letters.argmax(0), len(SCRIPTS) - 1)
            langs = batch.column(2).slice(a, n).to_pylist()
            band = [bands.get(lang) or bands[SCRIPTS[s]] for lang, s in zip(langs, script.tolist())]
            low, high, most, least = np.array(
                [[x.least_chars, x.most_chars, x.most_fallback, x.least_entropy] for x in band]).T
            failed = (base["n_words"] < least_words) | (100 * base["n_repeat_words"] > most_repeat * base["n_words"])
            inside = (chars >= low) & (chars <= high) & (fallback <= most) & (bits >= least)
            columns = {
                "doc_id": batch.column(0).slice(a, n),
                **{c: pa.array(base[c].astype(np.int64)) for c in BASE},
                "base_failed": pa.array(failed), "kept": pa.array(~failed & inside),
                "script": pa.array([SCRIPTS[s] for s in script.tolist()]),
                "n_tokens": pa.array(n_tokens.astype(np.int64)), "chars_per_token": pa.array(chars),
                "fallback_share": pa.array(fallback), "token_entropy": pa.array(bits),
                "place": pa.array([f"script {SCRIPTS[s]}" if lang is None else f"lang {lang}"
                                   for lang, s in zip(langs, script.tolist())]),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


CARRIED = {"place": StringType(), "n_tokens": LongType(), "chars_per_token": DoubleType(), "token_entropy": DoubleType()}

#: Places of the histograms that quantiles are read from, per unit.
GRAIN = 1000


def _step(tokens: str) -> Column:
    """Half octaves of the number of tokens: an entropy grows with it."""
    return F.floor(2 * F.log2(F.greatest(F.col(tokens), F.lit(1)))).cast("int")


def _low(traits: DataFrame, by: list[str], trait: str, low: float, least_rows: int) -> DataFrame:
    """The ``low`` quantile of a trait in each group of enough texts, from
    counts of its values to a thousandth: the same whatever the partitions."""
    counts = traits.groupBy(*by, F.floor(F.col(trait) * GRAIN).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*by)
    ranked = counts.withColumn("upto", F.sum("n").over(whole.orderBy("bin"))).withColumn("all", F.sum("n").over(whole))
    return (ranked.where((F.col("all") >= least_rows) & (F.col("upto") > low * F.col("all")))
            .groupBy(*by).agg((F.min("bin") / GRAIN).alias(trait)))


def floors(traits: DataFrame, low: float, least_rows: int) -> DataFrame:
    """(place, step, floor_chars, floor_entropy): the ``low`` quantiles of the
    texts that pass the base rules, by language (by script where it is null).
    The entropy's floor rises with the number of tokens.  A language of fewer
    than ``least_rows`` such texts has none; a step of fewer, that below."""
    passing = traits.where("NOT base_failed").withColumn("step", _step("n_tokens"))
    chars = _low(passing, ["place"], "chars_per_token", low, least_rows).withColumnRenamed("chars_per_token", "floor_chars")
    entropy = _low(passing, ["place", "step"], "token_entropy", low, least_rows)
    steps = chars.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(127))))
    rising = Window.partitionBy("place").orderBy("step")
    return steps.join(entropy, ["place", "step"], "left").select(
        "place", "step", "floor_chars", F.coalesce(F.max("token_entropy").over(rising), F.lit(0.0)).alias("floor_entropy"))


def _above(traits: DataFrame, limits: DataFrame, mark: str = "") -> DataFrame:
    """``traits`` with floor_chars and floor_entropy, null where there are none;
    ``mark`` stands before the names of the traits."""
    named = limits.select(F.col("place").alias(f"{mark}place"), F.col("step").alias(f"{mark}step"),
                          F.col("floor_chars").alias(f"{mark}floor_chars"), F.col("floor_entropy").alias(f"{mark}floor_entropy"))
    return traits.withColumn(f"{mark}step", _step(f"{mark}n_tokens")).join(
        F.broadcast(named), [f"{mark}place", f"{mark}step"], "left")


def _is_above(mark: str = "") -> Column:
    return ((F.col(f"{mark}chars_per_token") >= F.coalesce(f"{mark}floor_chars", F.lit(0.0)))
            & (F.col(f"{mark}token_entropy") >= F.coalesce(f"{mark}floor_entropy", F.lit(0.0))))


def apply_rules(docs: DataFrame, path: str, kind: str = "sentencepiece", byte_ids: frozenset[int] = frozenset(range(3, 259)),
                bands: dict[str, Band] | None = None, least_words: int = 50, most_repeat: int = 50,
                text: str = "text", key: str = "doc_id", lang: str = "lang", low: float | None = None,
                least_rows: int = 100) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed,
    kept, script, n_tokens, chars_per_token, fallback_share, token_entropy.

    Words are encoded one by one with the vocabulary at ``path`` (``kind``
    names its library); ``byte_ids`` are its single-byte tokens.  Null and
    empty texts have zero counts and fail the base rules.  A null or unknown
    language, or a missing column, leaves the choice of band to the script.
    With ``low``, a kept text also reaches that quantile of its language, see
    ``floors``.  Repeated rows give equal rows; other columns are ignored; an
    empty table gives an empty result.
    """
    traits = _traits(docs, path, kind, byte_ids, bands, least_words, most_repeat, text, key, lang)
    if low is not None:
        traits = common.written(traits, "traits")
        traits = _above(traits, floors(traits, low, least_rows)).withColumn("kept", F.col("kept") & _is_above())
    return traits.select("doc_id", *BASE, "base_failed", "kept", "script", "n_tokens", "chars_per_token",
                         "fallback_share", "token_entropy")


def _traits(docs: DataFrame, path: str, kind: str, byte_ids: frozenset[int], bands: dict[str, Band] | None,
            least_words: int, most_repeat: int, text: str, key: str | None, lang: str) -> DataFrame:
    number = F.lit(None) if key is None else F.col(key)
    language = F.col(lang).cast("string") if lang in docs.columns else F.lit(None).cast("string")
    texts = common.small_batches(docs.select(number.cast("long").alias("doc_id"),
                                             F.col(text).cast("string").alias("text"), language.alias("lang")))
    bands = BANDS if bands is None else {**BANDS, **bands}
    schema = ("doc_id long, " + ", ".join(f"{c} long" for c in BASE)
              + ", base_failed boolean, kept boolean, script string, n_tokens long, chars_per_token double, "
                "fallback_share double, token_entropy double, place string")
    return texts.mapInArrow(
        lambda it: _measure(it, kind, path, byte_ids, bands, least_words, most_repeat), schema)


def keep_passing(docs: DataFrame, path: str, kind: str = "sentencepiece",
                 byte_ids: frozenset[int] = frozenset(range(3, 259)), bands: dict[str, Band] | None = None,
                 least_words: int = 50, most_repeat: int = 50, text: str = "text", lang: str = "lang",
                 low: float | None = None, least_rows: int = 100, basis: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``apply_rules`` keeps,
    filtered as they stream by.  With ``low``, the texts of ``basis``, or else
    of ``docs``, are measured before, for the quantiles.

    Null and empty texts fail the base rules and go; repeated rows stay or go
    together; long texts are measured whole.  An empty table stays empty;
    columns of any name stay as they are."""
    at, of = docs.columns.index(text), docs.columns.index(lang) if lang in docs.columns else None
    mark, limits = "_fertility_", None
    while any(c.startswith(mark) for c in docs.columns):
        mark = f"_{mark}"
    carried = () if low is None else tuple(CARRIED)
    if low is not None:
        traits = _traits(docs if basis is None else basis, path, kind, byte_ids, bands, least_words, most_repeat, text,
                         None, lang)
        limits = common.written(floors(common.written(traits.select(*carried, "base_failed"), "traits"), low, least_rows),
                                "floors")
    bands = BANDS if bands is None else {**BANDS, **bands}

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            part = pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), batch.column(at), pa.nulls(n, pa.string()) if of is None else batch.column(of)],
                ["doc_id", "text", "lang"])
            found = pa.Table.from_batches(_measure(iter([part]), kind, path, byte_ids, bands, least_words, most_repeat))
            found = found.combine_chunks()
            for c in carried:
                batch = batch.append_column(mark + c, found.column(c).combine_chunks())
            yield batch.filter(found.column("kept").combine_chunks())

    schema = docs.schema
    for c in carried:
        schema = StructType([*schema.fields, StructField(mark + c, CARRIED[c])])
    kept = common.small_batches(docs).mapInArrow(passing, schema)
    return kept if limits is None else _above(kept, limits, mark).where(_is_above(mark)).select(*docs.columns)
