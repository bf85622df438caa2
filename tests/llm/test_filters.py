"""Filters that pass whole rows on: odd rows, clashing names, repeated ids."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import fertility, gam_quality, signature_join, toxicity_kn
from tests.llm import fixtures as X

NAMES = ("_key", "_crc", "_many", "id", "crc", "row", "many", "_fertility_n_tokens", "_fertility_place", "__fertility_step")


@pytest.fixture(scope="module")
def docs(spark):
    long = " ".join(f"word{i % 97} other{i % 31}" for i in range(4000))
    texts = [None, "", " \n", "a b c d e f", "a b c d e f", long, long + " end", "plain words " * 60] + [t for _, t in X.rows()[:30]]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(40).collect()]
    df = X.documents(spark, [*enumerate(texts), (3, texts[3]), (None, texts[3])])
    return df.withColumns({c: F.lit("mine") for c in NAMES})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(38)], "doc_id long, quality int, toxic int")


def stages(labels):
    path = P.path("piece_bpe_32k.model")
    return {"good": lambda df: gam_quality.keep_good(df, labels),
            "passing": lambda df: fertility.keep_passing(df, path, low=0.05),
            "fixed bands": lambda df: fertility.keep_passing(df, path),
            "one": signature_join.keep_one}


@pytest.mark.parametrize("name", ["good", "passing", "fixed bands", "one"])
def test_rows_come_back_as_they_were(docs, labels, name):
    stage = stages(labels)[name]
    kept = stage(docs)
    assert kept.schema == docs.schema
    rows, had = [tuple(r) for r in kept.collect()], [tuple(r) for r in docs.collect()]
    assert all(r in had for r in rows) and 0 < len(rows) <= len(had)
    assert stage(docs.limit(0)).count() == 0
    if name == "one":
        assert sum(r[1] == "a b c d e f" for r in rows) == 1 and sum(not (r[1] or "").split() for r in rows) >= 3


def test_a_repeated_id_trains_once(spark, labels):
    """Whatever the order of the rows, and however many one id has."""
    data = [(i, f"some text number {i} with words {'bad' if i % 2 else 'good'} " * (1 + i % 5)) for i in range(38)]
    data += [(5, f"another text {k}") for k in range(400)]
    df = X.documents(spark, data)
    for score in (lambda d: gam_quality.score_quality(d, labels), lambda d: toxicity_kn.score_toxicity(d, labels)):
        one, other = (sorted((r.doc_id, r.predicted, r.score) for r in score(d).collect())
                      for d in (df.repartition(1), df.repartition(9).orderBy(F.desc("text"))))
        assert [r[:2] for r in one] == [r[:2] for r in other]
        assert max(abs(a[2] - b[2]) for a, b in zip(one, other)) < 1e-12  # sums over slices of other sizes


def test_sampled_rows_are_bounded_by_ids(spark, labels):
    rows = gam_quality.trait_table(X.documents(spark, [(5, f"text {k}") for k in range(300)] + [(1, "a"), (3, "b")]))
    model = gam_quality.train(rows, labels)
    assert model is not None
