"""Helpers shared by the operators: inputs, written tables, graph components."""

from __future__ import annotations

import pickle
import uuid

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/ll-{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage reliably: a lost executor costs no recomputation, and
    what partition numbers or random draws decided stays decided.
    """
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).withColumns({})


def drop_written(df: DataFrame) -> None:
    """Delete a table that ``written`` made and that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the rows of an Arrow batch, which holds whole texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return df


def send(spark: SparkSession, model: object) -> Broadcast[bytes]:
    """Broadcast an object of this package's classes by value: tasks take
    it with ``received``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def received(held: Broadcast[bytes]) -> object:
    """What ``send`` sent, in a task."""
    return pickle.loads(held.value)


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links(a, b)``: one row ``(id, root)`` per
    linked id, ``root`` the smallest id that it reaches.

    Alternating large-star and small-star rounds (Kiveris et al., 2014).  A
    round needs minima by id, which combine map-side, and joins, whose
    large partitions Spark splits: no neighbour list is ever gathered, so a
    hub of any degree is fine.  Every round is written to the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = written(edges.where("u > v").distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (small.select("u", F.col("m").alias("v"))
                 .unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v"))))
        after = written(small.where("u > v").distinct(), "edges")
        drop_written(edges)
        edges = after
    roots = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("id"), "root").distinct())
