"""Embedding near-duplicates by NN-descent.

Vectors are compared with those of the same label only.  Equal vectors are one
object with a count.  Each object starts with neighbours from random
projections, blocks of vectors whose signs agree; then rounds of neighbours of
neighbours improve the lists: whatever appears together around an object,
forward or backward, is compared, and the nearest stay.  Rounds go on while
lists still change.  Lists are short, so where an object has more links than
its list holds, whole components may hang together by links that no list has:
all objects whose signs agree are then compared with those of other components.
An object's links are counted, and never listed, among all objects of its
component, compared block by block.  An audit holds the counts and the
components of a fixed query set against brute force; while it finds a link that
is missing, passes with further signs go on, and if too many stay missing the
query fails.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import common

LOG = logging.getLogger(__name__)


def _matrix(column: pd.Series | list) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _unit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows with the bytes of the unit vector (null if the vector links with
    nothing)."""
    for pdf in batches:
        units = []
        for v in pdf["embedding"]:
            x = None if v is None else np.array([np.nan if e is None else e for e in v], np.float64)
            if x is None or not len(x) or not np.isfinite(x).all() or not x.any():
                units.append(None)
                continue
            x = x / np.abs(x).max()
            units.append((x / np.linalg.norm(x)).tobytes())
        yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "unit": units, "key": pdf["key"]})


def _coded(objects: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """(id, label, t, code): the sign code of each object in each table."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            size = pdf["unit"].map(len).to_numpy()
            codes = np.zeros((len(pdf), tables), np.int64)
            for s in np.unique(size).tolist():
                at = np.flatnonzero(size == s)
                planes = np.random.default_rng([seed, s // 8]).standard_normal((s // 8, tables * bits))
                signs = (_matrix(pdf["unit"].iloc[at]) @ planes > 0).reshape(len(at), tables, bits)
                codes[at] = signs @ (1 << np.arange(bits))
            yield pd.DataFrame({"id": np.repeat(pdf["id"].to_numpy(), tables),
                                "label": np.repeat(pdf["label"].to_numpy(), tables),
                                "t": np.tile(np.arange(tables, dtype=np.int32), len(pdf)), "code": codes.reshape(-1)})

    return objects.select("id", "label", "unit").mapInPandas(run, "id long, label long, t int, code long")


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each ``u``; ranks are cut before the exchange too."""
    w = Window.partitionBy("u").orderBy(F.desc("cos"), "v")
    return edges.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r")


def _compared(groups: DataFrame, k: int) -> DataFrame:
    """Edges (u, v, cos) among the members of each group (g, ids, units): for
    each member the ``k`` nearest others."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            us, vs, cs = [], [], []
            for ids, units in zip(pdf["ids"], pdf["units"]):
                ids = np.asarray(ids)
                x = _matrix(units)
                cos = x @ x.T
                np.fill_diagonal(cos, -2)
                n = min(k, len(ids) - 1)
                top = np.argpartition(-cos, n - 1, axis=1)[:, :n]
                rows = np.repeat(np.arange(len(ids)), n)
                us.append(ids[rows])
                vs.append(ids[top.reshape(-1)])
                cs.append(cos[rows, top.reshape(-1)])
            if us:
                yield pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs), "cos": np.concatenate(cs)})

    return groups.mapInPandas(run, "u long, v long, cos double")


def _start(objects: DataFrame, coded: DataFrame, k: int, block: int) -> DataFrame:
    """Edges within blocks of objects of one label whose sign codes agree.

    A code that many share is dealt on by further hashes of the object into
    blocks of about ``block``; what that separates the rounds bring together,
    or else ``_crossing``, which deals nothing.
    """
    sizes = coded.groupBy("label", "t", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = coded.join(sizes, ["label", "t", "code"]).withColumn(
        "part", F.pmod(F.xxhash64("id", "t"), F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / block))))
    dealt = dealt.join(objects.select("id", "unit"), "id")
    groups = (dealt.groupBy("label", "t", "code", "part")
              .agg(F.collect_list("id").alias("ids"), F.collect_list("unit").alias("units")).where("size(ids) > 1"))
    return _compared(groups, k)


def _round(graph: DataFrame, objects: DataFrame, k: int) -> DataFrame:
    """Edges among each object and its neighbours, forward and backward."""
    back = _nearest(graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "cos"), k)
    around = (graph.select("u", "v").unionByName(back.select("u", "v"))
              .unionByName(graph.select("u", F.col("u").alias("v"))).distinct())
    vectors = objects.select(F.col("id").alias("v"), "unit")
    groups = (around.join(vectors, "v").groupBy("u")
              .agg(F.collect_list("v").alias("ids"), F.collect_list("unit").alias("units")).where("size(ids) > 1"))
    return _compared(groups, k)


def _merged(old: DataFrame, new: DataFrame, k: int) -> DataFrame:
    both = old.unionByName(new).groupBy("u", "v").agg(F.max("cos").alias("cos"))
    return common.written(_nearest(both, k), "graph")


def _crossing(objects: DataFrame, comps: DataFrame, coded: DataFrame, threshold: float, block: int) -> DataFrame:
    """Pairs (a, b) of roots of different components that a link joins.

    All objects of one label and code are compared, chunk against chunk, but
    for those of one component: the chunks of a component larger than a block
    hold no other, and are not compared among themselves.  An object without
    links is a component of its own.
    """
    size = comps.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    held = objects.select("id").join(comps.join(size, "root"), "id", "left").select(
        "id", F.coalesce("root", "id").alias("root"), F.when(F.col("m") > block, F.col("root")).otherwise(-1).alias("own"))
    placed = common.written(coded.join(held, "id"), "placed")
    runs = placed.groupBy("label", "t", "code", "own").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    runs = runs.withColumn("parts", F.ceil(F.col("n") / block))
    mixed = (runs.groupBy("label", "t", "code").agg(F.min("low").alias("low"), F.max("high").alias("high"),
                                                     F.sum("parts").alias("chunks")).where("low < high").drop("low", "high"))
    dealt = (placed.join(runs.select("label", "t", "code", "own", "parts").join(mixed, ["label", "t", "code"]),
                         ["label", "t", "code", "own"])
             .withColumn("part", F.pmod(F.xxhash64("id", "t"), "parts")).join(objects.select("id", "unit"), "id"))
    held = common.written(dealt.groupBy("label", "t", "code", "chunks", "own", "part").agg(
        F.collect_list("root").alias("roots"), F.collect_list("unit").alias("units")), "chunks")
    many = held.where("chunks > 1")
    other = many.select("label", "t", "code", F.struct("own", "part").alias("at2"), F.col("own").alias("own2"),
                        F.col("roots").alias("roots2"), F.col("units").alias("units2"))
    pairs = (many.withColumn("at", F.struct("own", "part")).join(other, ["label", "t", "code"])
             .where("at <= at2 AND (own <> own2 OR own = -1)"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r, x, r2, x2 in zip(pdf["roots"], pdf["units"], pdf["roots2"], pdf["units2"]):
                r, r2 = np.asarray(r), np.asarray(r2)
                i, j = np.nonzero((_matrix(x) @ _matrix(x2).T >= threshold) & (r[:, None] != r2[None, :]))
                found = np.unique(np.sort(np.stack([r[i], r2[j]], 1), axis=1), axis=0)
                yield pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    alone = held.where("chunks = 1").select("roots", "units", F.col("roots").alias("roots2"), F.col("units").alias("units2"))
    pairs = pairs.select("roots", "units", "roots2", "units2").unionByName(alone)
    return common.written(pairs.mapInPandas(run, "a long, b long").distinct(), "crossing")


def _audit(objects: DataFrame, comps: DataFrame, n: int, threshold: float, every: int, queries: int,
           size: int = 2048) -> tuple[int, int, int, int]:
    """Of the query objects, by brute force over all objects, block by block:
    their links, those inside their component, which are the ones that
    ``n_links`` counts; the queries with links, and those all of whose links
    are inside.

    Queries are the objects whose smallest vec_id is divisible by ``every``,
    or by as much more as leaves about ``queries`` of them.
    """
    rooted = objects.join(comps, "id", "left").withColumn("root", F.coalesce("root", "id"))
    query = rooted.where(F.pmod("least", F.lit(max(every, n // queries))) == 0)
    blocks = F.lit(max(1, n // size))
    asked = (query.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(max(1, min(n // every, queries) // size))))
             .groupBy("label", "b").agg(F.collect_list("id").alias("qi"), F.collect_list("root").alias("qr"),
                                        F.collect_list("unit").alias("qx")))
    held = (rooted.withColumn("c", F.pmod(F.xxhash64("id", F.lit(5)), blocks))
            .groupBy("label", "c").agg(F.collect_list("id").alias("oi"), F.collect_list("root").alias("ro"),
                                       F.collect_list("unit").alias("ox")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for qi, qr, qx, oi, ro, ox in zip(pdf["qi"], pdf["qr"], pdf["qx"], pdf["oi"], pdf["ro"], pdf["ox"]):
                link = _matrix(qx) @ _matrix(ox).T >= threshold
                link &= np.asarray(qi)[:, None] != np.asarray(oi)[None, :]
                inside = link & (np.asarray(qr)[:, None] == np.asarray(ro)[None, :])
                yield pd.DataFrame({"u": np.asarray(qi), "n": link.sum(axis=1).astype(np.int64),
                                    "m": inside.sum(axis=1).astype(np.int64)})

    each = (asked.join(held, "label").mapInPandas(run, "u long, n long, m long")
            .groupBy("u").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).where("n > 0"))
    row = each.agg(F.sum("n"), F.sum("m"), F.count(F.lit(1)), F.count_if(F.col("n") == F.col("m"))).first()
    return row[0] or 0, row[1] or 0, row[2], row[3]


def _codes_for(largest: int, threshold: float, block: int, tables: int, bits: int, miss: float) -> tuple[int, int]:
    """Tables and bits for labels of at most ``largest`` objects: codes so long
    that about ``block`` objects share one, and as many tables as leave a link
    at the threshold apart in all of them with probability ``miss`` at most."""
    bits = min(62, max(bits, math.ceil(math.log2(max(1, largest) / block))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return max(tables, math.ceil(math.log(miss) / math.log1p(-same))), bits


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, k: int = 12, tables: int = 8, bits: int = 8,
                    block: int = 256, most_rounds: int = 6, least_recall: float = 0.95, audit_every: int = 100,
                    audit_queries: int = 20_000, seed: int = 11, miss: float = 0.001, most_passes: int = 6) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id,
    n_links, component_id, kept.

    Vectors that are null, empty or zero, or hold a null or non-finite
    component, and those without a label link with nothing.  Equal vectors of
    one label link.  Vectors of different lengths link with nothing in the
    other length.  Repeated rows of one vec_id are separate vectors.  Other
    columns are ignored.  An empty table gives an empty result.

    ``tables`` and ``bits`` are the least numbers; both grow with the largest
    label.  Passes with further codes go on while the audit finds a link
    between components; if after ``most_passes`` it still misses more than
    1 - ``least_recall`` of the links or of the queries, that is an error.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("key", F.xxhash64(F.size("embedding"), F.to_json("embedding")))
    rows = rows.mapInPandas(_unit, "vec_id long, label long, unit binary, key long")
    rows = common.written(rows, "units")
    good = rows.where("unit IS NOT NULL AND label IS NOT NULL").withColumn(
        "label", F.xxhash64("label", F.octet_length("unit")))
    objects = good.groupBy("label", "key").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit"))
    objects = common.written(objects.withColumn("id", F.monotonically_increasing_id()), "objects")

    n = objects.count()
    largest = objects.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    tables, bits = _codes_for(largest, threshold, block, tables, bits, miss)
    coded = common.written(_coded(objects, tables, bits, seed), "codes")
    graph = _merged(objects.sparkSession.createDataFrame([], "u long, v long, cos double"),
                    _start(objects, coded, k, block), k)
    for number in range(most_rounds):
        after = _merged(graph, _round(graph, objects, k), k)
        changed = after.join(graph.select("u", "v"), ["u", "v"], "left_anti").count()
        total = after.count()
        graph = after
        LOG.info("round %d: %d of %d edges new", number, changed, total)
        if changed <= 0.05 * total:
            break

    links = graph.where(F.col("cos") >= threshold)
    comps = common.components(links.select(F.col("u").alias("a"), F.col("v").alias("b")))
    for number in range(most_passes):
        if number:
            coded = common.written(_coded(objects, tables, bits, seed + number), "codes")
        found = _crossing(objects, comps, coded, threshold, block)
        comps = common.written(common.components(
            comps.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(found)), "components")
        true, inside, asked, whole = _audit(objects, comps, n, threshold, audit_every, audit_queries)
        LOG.info("pass %d: %d of %d links, %d of %d queries", number, inside, true, whole, asked)
        if inside == true:
            break
    if inside < least_recall * true or whole < least_recall * asked:
        raise RuntimeError(f"after {most_passes} passes {inside} of {true} audited links are found, "
                           f"all links of {whole} of {asked} queries")
    member = common.written(comps.join(objects.select("id", "label", "least", "copies", "unit"), "id"), "members")
    degrees = _degrees(member, threshold, block)
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    full = member.join(least, "root").join(degrees, "id").select("id", "component_id", "n")
    of = (objects.join(full, "id", "left")
          .select("label", "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                  F.coalesce("component_id", "least").alias("component_id")))
    linked = good.join(of, ["label", "key"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("unit IS NULL OR label IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id",
                                            (F.col("vec_id") == F.col("component_id")).alias("kept"))


def _degrees(member: DataFrame, threshold: float, block: int) -> DataFrame:
    """For each object the vectors that link with it, equal ones aside: all
    objects of its component are compared, block against block."""
    size = member.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    parts = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("m") / block))
    dealt = member.join(size, "root").withColumn("parts", parts).withColumn("b", F.pmod(F.xxhash64("id"), parts))
    blocks = common.written(dealt.groupBy("root", "b", "parts").agg(
        F.collect_list("id").alias("ids"), F.collect_list("unit").alias("units"),
        F.collect_list("copies").alias("copies")), "blocks")
    other = blocks.select("root", F.col("b").alias("c"), F.col("ids").alias("ids2"), F.col("units").alias("units2"),
                          F.col("copies").alias("copies2"))
    pairs = (blocks.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
             .join(other, ["root", "c"]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ids, x, ids2, x2, copies in zip(pdf["ids"], pdf["units"], pdf["ids2"], pdf["units2"], pdf["copies2"]):
                cos = _matrix(x) @ _matrix(x2).T
                cos[np.asarray(ids)[:, None] == np.asarray(ids2)[None, :]] = -2
                yield pd.DataFrame({"id": np.asarray(ids), "n": (cos >= threshold) @ np.asarray(copies, np.int64)})

    return pairs.mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
