"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def cluster_conf(total_cores: int, waves: int = 3) -> dict[str, str]:
    """Settings for a batch load on ``total_cores``: AQE starts wide and coalesces to ~128 MB tasks.

    Hash-partitioned groups of one hot key are split by the AQE skew join; it is forced because a
    later aggregate on the same key would otherwise switch it off.
    """
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(total_cores * waves),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.shuffle.partitions": str(total_cores * waves),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.parquet.filterPushdown": "true",
        # files are compressed: size estimates for broadcasts count what is read, not what is stored
        "spark.sql.sources.fileCompressionFactor": "4.0",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }


def local_session(app: str = "tidewright", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; on a cluster the submitted session is used as it is."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = {
        **cluster_conf(partitions, waves=1),
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",  # no call-site capture per column expression
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidewright-wh-"),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class NoSharedFolder(RuntimeError):
    """A cluster session that names no folder which driver and executors share."""


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local session without one gets a folder of its own."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise NoSharedFolder(f"set {CHECKPOINT_CONF}: executors on other machines cannot read a local folder")
        root = tempfile.mkdtemp(prefix="tidewright-scratch-")
        spark.conf.set(CHECKPOINT_CONF, root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody used before, below the shared scratch folder."""
    return f"{scratch_root(spark)}/tidewright/{label}-{uuid.uuid4().hex}"


# of one write: it leaves no shuffle files behind (else they stay until the driver happens to collect its garbage) ...
REMOVE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# ... and rows that lie by one of several join columns are not dealt anew by all of them
BY_ONE_KEY = {**REMOVE_SHUFFLES, "spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings of what is planned and run inside; as they were before afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """The frame written once to shared storage and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _settings(spark, REMOVE_SHUFFLES):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_tasks(spark: SparkSession) -> int:
    """Partitions that a shuffle of this session starts with."""
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions"))


def written_by(df: DataFrame, label: str, key: str) -> DataFrame:
    """As ``written``, in buckets by the hash of ``key``: joins by it read the table without a shuffle, and so do joins by more columns in
    a frame that is written in this way itself. All rows of a key are read by one task.

    The catalog knows the table only until it is read; its files stay like those of other scratch tables.
    """
    spark = df.sparkSession
    name = f"spark_catalog.default.tidewright_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").mode("errorifexists").option("compression", "zstd").option("path", scratch_path(spark, label))
    with _settings(spark, BY_ONE_KEY):
        writer.bucketBy(shuffle_tasks(spark), key).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
