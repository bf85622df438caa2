"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(cpus: int | None = None, shuffle_partitions: int | None = None,
              app: str = "ledgerlens") -> SparkSession:
    """A local session tuned for the test machine.

    On a cluster the session comes from the launcher; only the SQL settings
    here (AQE, UTC, ANSI) matter there.
    """
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or max(8, 2 * cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we only
    create our own (a fresh temp folder) when none is set and the master is
    local, as in tests.  On a cluster a missing setting is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store)")
        conf_dir = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads; 0 if it reads none."""
    sc = df.sparkSession.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    paths = (jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)) for name in df.inputFiles())
    return sum(path.getFileSystem(conf).getFileStatus(path).getLen() for path in paths)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings for a cluster run over ``input_bytes`` of Parquet.

    Shuffle partitions are sized so a post-shuffle partition holds about
    ``target_partition_bytes`` of input at the start (AQE coalesces from
    there), between two and ten waves of tasks (more reducers only grow the
    shuffle's block metadata); scans split at the same size.  The
    checkpoint folder must be shared storage named by the cluster
    (``spark.checkpoint.dir``), so it is not set here.
    """
    slots = max(1, executors * cores_per_executor)
    parts = min(10 * slots, max(2 * slots, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.session.timeZone": "UTC",
    }
