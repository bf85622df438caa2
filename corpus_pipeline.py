"""From raw documents to packed training sequences, in four stages.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame,
which is written and read again as the next one's ``docs``.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import common, fertility, gam_quality, packing, signature_join


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model scores 0.7 or more."""
    return gam_quality.keep_good(docs, common.read_table(spark, sf_dir, "labels"), threshold=0.7)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands, whose lower
    limits are quantiles of all documents."""
    return fertility.keep_passing(docs, public_tokenizers.path("piece_bpe_32k.model"), low=0.05,
                                  basis=common.read_table(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return signature_join.keep_one(docs, width=5, percent=75)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 2048."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=2048, end_id=0, special=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("best_fit_packing", best_fit_packing),
]

#: Models, vocabularies and packing are not expressible in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
