"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from ledgerlens.llm import (
    byte_bpe, fertility, gam_quality, lexical_search, license_scan, nn_descent, packing, sharding, signature_join,
    toxicity_kn, url_lists, whitening, window_packing,
)
from ledgerlens.llm.common import read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all ``documents``."""
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op2_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of at most 2048 tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        size=2048, end_id=0, special=True)


def op3_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and fertility rules of ``documents``."""
    return fertility.apply_rules(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                                 low=0.05)


def op4_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 40 shards, uniformly, under the law ``rows``."""
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=40)


def op5_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of ``documents`` as ``labels.quality`` marks it."""
    return gam_quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                                     threshold=0.7)


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of ``embeddings`` of one label: cosine 0.98 or more."""
    return nn_descent.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op7_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of ``documents``: five words, similarity 0.75 or more."""
    out = signature_join.near_duplicates(read_table(spark, sf_dir, "documents"), width=5, percent=75)
    return out.select("doc_id", "n_shingles", "component_id")


def op8_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of ``documents`` as ``labels.toxic`` marks it."""
    return toxicity_kn.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                                      threshold=0.3)


def op9_merge_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text of ``documents``, and the bytes that they decode to."""
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"),
                               public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def url_events(captures: DataFrame) -> DataFrame:
    """Dated list events that the captures themselves give rise to.

    A host's domain (its last three labels) is blocked from the day that a
    capture of it names a spam host or carries a tracking tag, and cleared 21
    days later unless it is seen again that day; the language folder of a host
    is allowed from the day of a plain ``.html`` capture, for 30 days.
    """
    seen = captures.select(url_lists.host("url").alias("host"), url_lists.path("url").alias("path"), "url", "fetch_day")
    spam = seen.where(F.col("url").contains("utm_source=") | F.col("host").rlike("spam|pills|casino"))
    spam = spam.select(F.lit("block").alias("list"), F.lit("domain").alias("kind"),
                       F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("pattern"), "fetch_day",
                       F.lit(21).alias("days"))
    plain = seen.where(F.col("path").endswith(".html")).select(
        F.lit("allow").alias("list"), F.lit("prefix").alias("kind"),
        F.concat("host", F.regexp_extract("path", "^(/[^/]*/)", 1)).alias("pattern"), "fetch_day", F.lit(30).alias("days"))
    both = spam.unionByName(plain).distinct()
    return (both.select("list", "kind", "pattern", F.lit("add").alias("action"), F.col("fetch_day").alias("day"))
            .unionByName(both.select("list", "kind", "pattern", F.lit("remove").alias("action"),
                                     F.date_add("fetch_day", F.col("days")).alias("day"))))


def op10_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every capture of ``pages`` against the list entries of its fetch day.

    The table has no fetch time: a page is taken as fetched on the day of 2024
    that its id gives.  The lists' events come from the captures.
    """
    captures = read_table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), "url",
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(366)).cast("int")).alias("fetch_day"))
    return url_lists.judge(captures, url_events(captures))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 highest-scoring ``documents`` of each ``benchmark`` item."""
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=50)


OP11_SQL = r"""
WITH words AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
counted AS (SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT row, sum(tf)::BIGINT AS n FROM counted GROUP BY row),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), total),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, row, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN lengths USING (row), total
  GROUP BY item_id, row)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50
"""


def op12_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in windows of at most 2048 tokens, hardly padded."""
    return window_packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                               size=2048, end_id=1)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings`` whitened along their first 16 components."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=16)


OP10_SQL = r"""
WITH cap AS (
  SELECT page_id AS id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetch_day,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*?)\.*(?::[0-9]*)?(?:[/?#]|$)', 1) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS raw_path
  FROM pages),
c AS (SELECT *, CASE WHEN raw_path = '' THEN '/' ELSE raw_path END AS path FROM cap),
seen AS (
  SELECT DISTINCT 'block' AS list, 'domain' AS kind, regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS pattern,
         fetch_day AS day, 21 AS days
  FROM c WHERE contains(url, 'utm_source=') OR regexp_matches(host, 'spam|pills|casino')
  UNION ALL
  SELECT DISTINCT 'allow', 'prefix', host || regexp_extract(path, '^(/[^/]*/)', 1), fetch_day, 30
  FROM c WHERE path LIKE '%.html'),
ev AS (
  SELECT list, kind, pattern, day, max(removed) AS removed FROM (
    SELECT list, kind, pattern, day, 0 AS removed FROM seen
    UNION ALL SELECT list, kind, pattern, day + days, 1 FROM seen) GROUP BY ALL),
valid AS (
  SELECT list, kind, pattern, day AS valid_from, removed,
         (SELECT min(l.day) FROM ev l WHERE l.list = e.list AND l.kind = e.kind AND l.pattern = e.pattern
            AND l.day > e.day AND l.removed = 1) AS valid_to,
         (SELECT max(l.day) FROM ev l WHERE l.list = e.list AND l.kind = e.kind AND l.pattern = e.pattern
            AND l.day < e.day) AS before_day
  FROM ev e WHERE removed = 0),
starts AS (
  SELECT v.* FROM valid v LEFT JOIN ev b ON b.list = v.list AND b.kind = v.kind AND b.pattern = v.pattern
    AND b.day = v.before_day WHERE b.removed IS NULL OR b.removed = 1),
met AS (
  SELECT c.id, s.list, s.kind, s.pattern, s.valid_from
  FROM c JOIN starts s ON c.fetch_day >= s.valid_from AND (s.valid_to IS NULL OR c.fetch_day < s.valid_to)
    AND ((s.kind = 'domain' AND (c.host = s.pattern OR ends_with(c.host, '.' || s.pattern)))
      OR (s.kind = 'prefix' AND starts_with(c.host || c.path, s.pattern)
          AND (ends_with(s.pattern, '/') OR c.host || c.path = s.pattern)))
  WHERE c.host <> ''),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY id) AS n_active, row_number() OVER (PARTITION BY id ORDER BY
    (kind = 'prefix') DESC, length(pattern) DESC, (list = 'allow') DESC, pattern DESC, list DESC, valid_from DESC) AS r
  FROM met)
SELECT c.id, c.host, c.fetch_day, coalesce(r.n_active, 0) AS n_active, coalesce(r.list = 'block', false) AS blocked,
       coalesce(r.list || ':' || r.pattern, '') AS decided_by, r.valid_from
FROM c LEFT JOIN ranked r ON r.id = c.id AND r.r = 1
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_license_scan, op2_residual_packing, op3_tokeniser_fertility, op4_hypergeometric_shards,
        op5_additive_quality, op6_nn_descent, op7_signature_trees, op8_kneser_ney_toxicity, op9_merge_fold, op10_temporal_url_lists,
        op11_lexical_search, op12_window_packing, op13_embedding_whitening,
    )}


def oracle_sql() -> dict[str, str]:
    return {"op10_temporal_url_lists": OP10_SQL, "op11_lexical_search": OP11_SQL}
