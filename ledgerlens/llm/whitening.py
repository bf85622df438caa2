"""Whitening of embeddings by a bidiagonal qd solver.

Entries become whole numbers, so that distinct vectors, their number and
their sums are exact.  Rows of the fit list, centred, are reduced to one
triangle by QR: block by block in each partition, then triangles in a tree
of tasks.  The triangle, d x d whatever the rows, goes to ``qd`` on the
driver; its right vectors and values whiten every row in one scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.qd import right_vectors

MERGE_BYTES = 64 << 20  #: of the triangles that one task of the tree takes
RANK = 1e-22  #: variances below this share of the largest are rounding


@dataclass
class Whitening:
    """A fit: vectors as columns, in falling order of variance, over their
    standard deviations."""

    n: int  # distinct vectors
    sums: list[int]  # of the whole numbers, by dimension
    scale: float
    project: np.ndarray
    explained: np.ndarray
    identity_error: float


def _whole(column: pa.Array, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of floor(scale * entry)) of the rows without a
    null or non-finite entry, by number of dimensions."""
    size = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    value = column.flatten().to_numpy(zero_copy_only=False)
    at = np.cumsum(size) - size
    good = size > 0
    good[np.repeat(np.arange(len(size)), size)[~np.isfinite(value)]] = False
    for d in np.unique(size[good]).tolist():
        rows = np.flatnonzero(good & (size == d))
        scaled = np.floor(value[at[rows][:, None] + np.arange(d)] * scale)
        if np.abs(scaled).max() >= 1 << 62:
            raise ArithmeticError("a scaled entry is beyond the range of a long")
        yield rows, scaled.astype(np.int64)


def _packed(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """Each vector as bytes: the width of its numbers, then the numbers."""
    for batch in batches:
        for _, x in _whole(batch.column(0), scale):
            largest = np.abs(x).max(axis=1)
            out = []
            width = np.select([largest < 1 << 7, largest < 1 << 15, largest < 1 << 31], [1, 2, 4], 8)
            for w in (1, 2, 4, 8):
                out += [bytes([w]) + row.tobytes() for row in x[width == w].astype(f"<i{w}")]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["x"])


def _unpacked(column: pa.Array) -> Iterator[np.ndarray]:
    """Matrices of the vectors that ``_packed`` made."""
    rows: dict[tuple[int, int], list[bytes]] = {}
    for row in column.to_pylist():
        rows.setdefault((row[0], len(row)), []).append(row[1:])
    for (width, _), some in rows.items():
        yield np.frombuffer(b"".join(some), f"<i{width}").reshape(len(some), -1).astype(np.int64)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: longs if they are wide enough."""
    most = max(int(np.abs(x).max()) * n, max(map(abs, sums))) if x.size else 0
    kind = np.int64 if most < 1 << 61 else object
    return x.astype(kind) * n - np.array(sums, kind)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list] = {}
    for batch in batches:
        for x in _unpacked(batch.column(0)):
            kind = np.int64 if int(np.abs(x).max()) * len(x) < 1 << 62 else object
            held = total.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
            held[0] += len(x)
            held[1] += x.astype(kind).sum(axis=0).astype(object)
    for d, (n, s) in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * (d + 1)), pa.array(range(-1, d)), pa.array([str(v) for v in (n, *s)])], ["d", "place", "total"])


def _triangles(batches: Iterator[pa.RecordBatch], n: int, sums: list[int]) -> Iterator[pa.RecordBatch]:
    """One triangle of all rows of the partition."""
    d = len(sums)
    held, rows = [np.zeros((0, d))], 0
    for batch in batches:
        for x in _unpacked(batch.column(0)):
            held.append((_centred(x, n, sums) / n).astype(float))
            rows += len(x)
            if rows >= 8 * d:
                held, rows = [np.linalg.qr(np.concatenate(held), mode="r")], 0
    r = np.linalg.qr(np.concatenate(held), mode="r")
    if len(r):
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])


def _stacked(column: list[bytes], d: int) -> np.ndarray:
    return np.linalg.qr(np.concatenate([np.frombuffer(r).reshape(-1, d) for r in column]), mode="r")


def _moments(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    """Sums and sums of products of the whitened rows of the partition."""
    k = model.project.shape[1]
    first, second = np.zeros(k), np.zeros((k, k))
    for batch in batches:
        for x in _unpacked(batch.column(0)):
            z = (_centred(x, model.n, model.sums) / model.n).astype(float) @ model.project
            first += z.sum(axis=0)
            second += z.T @ z
    value = np.concatenate((first, second.ravel()))
    yield pa.RecordBatch.from_arrays([pa.array(range(len(value))), pa.array(value)], ["place", "value"])


def _vectors(table: DataFrame, vector: str) -> DataFrame:
    return table.select(F.col(vector).cast("array<double>").alias("v"))


def fit(table: DataFrame, vector: str = "embedding", components: int = 16, scale: float = 64.0) -> Whitening | None:
    """The whitening of the distinct vectors of ``table``; None if there are none.

    Entries count as floor(scale * entry).  Vectors of different lengths are
    an error, as are scaled entries beyond 2**62.  Directions without variance
    are no components, so there may be fewer than ``components``.
    """
    spark = table.sparkSession
    listed = common.written(_vectors(table, vector).mapInArrow(lambda it: _packed(it, scale), "x binary").distinct(), "fit")
    totals = (listed.mapInArrow(_sums, "d long, place long, total string")
              .groupBy("d", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    if not totals:
        common.drop_written(listed)
        return None
    if len({row["d"] for row in totals}) > 1:
        raise ValueError(f"vectors of different lengths: {sorted({row['d'] for row in totals})}")
    n, *sums = (int(row["total"]) for row in sorted(totals, key=lambda row: row["place"]))
    d = len(sums)

    parts = common.written(listed.mapInArrow(lambda it: _triangles(it, n, sums), "r binary")
                           .select(F.spark_partition_id().cast("long").alias("g"), "r"), "triangles")
    fan = int(min(64, max(2, MERGE_BYTES // (8 * d * d))))
    while parts.agg(F.max("g")).first()[0]:
        merge = lambda pdf: pd.DataFrame({"g": pdf["g"][:1] // fan, "r": [_stacked(pdf["r"].tolist(), d).tobytes()]})
        after = common.written(parts.groupBy(F.floor(F.col("g") / fan)).applyInPandas(merge, "g long, r binary"), "triangles")
        common.drop_written(parts)
        parts = after
    triangle = _stacked([bytes(parts.first()["r"])], d)  # d x d
    common.drop_written(parts)

    values, vectors = right_vectors(np.concatenate((triangle, np.zeros((d - len(triangle), d)))))
    k = min(components, int((values > RANK * values[0]).sum()))
    model = Whitening(n, sums, scale, vectors[:, :k] / np.sqrt(values[:k] / n), values[:k] / max(values.sum(), 1e-300), 0.0)
    held = common.send(spark, model)
    moments = {row["place"]: row["value"] for row in listed.mapInArrow(
        lambda it: _moments(it, common.received(held)), "place long, value double")
        .groupBy("place").agg(F.sum("value").alias("value")).collect()}  # k + k * k rows
    value = np.array([moments[i] for i in range(k + k * k)]) / n
    covariance = value[k:].reshape(k, k) - np.outer(value[:k], value[:k])
    model.identity_error = float(np.abs(covariance - np.eye(k)).max(initial=0.0))
    common.drop_written(listed)
    return model


def _transformed(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, x in _whole(batch.column(1), model.scale):
            m = _centred(x, model.n, model.sums)
            if (m.astype(float) ** 2).sum(axis=1).max() >= 9.2e18:
                raise ArithmeticError("a deviation is beyond the range of a long")
            z = (m / model.n).astype(float) @ model.project
            ends = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array((m * m).sum(axis=1).astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel()))], ["vec_id", "deviation", "whitened"])


def transform(table: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, deviation and the whitened vector (array<double>) of each row
    without a null or non-finite entry."""
    held = common.send(table.sparkSession, model)
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInArrow(lambda it: _transformed(it, common.received(held)),
                           "vec_id long, deviation long, whitened array<double>")


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16) -> DataFrame:
    """One row per remaining row and component: vec_id, component (from 1),
    n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds a null or non-finite entry are
    left out; repeated rows, also of one vec_id or of a null one, each have
    their rows, and count once in the fit.  Equal variances leave the choice of
    their components open.  With fewer directions of variance than
    ``components`` there are fewer components; one distinct vector has none.  An
    empty table gives an empty result; other columns are ignored.
    """
    spark = table.sparkSession
    model = fit(table, vector, components)
    if model is None or not len(model.explained):
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    explained = F.array(*[F.lit(float(v)) for v in model.explained])
    rows = transform(table, model, key, vector).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                       "whitened", F.get(explained, F.col("at")).alias("explained"),
                       F.lit(model.identity_error).alias("identity_error"))
