"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A commit uploads what changed instead of a snapshot, and a join keeps one store a partition
    # instead of four.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # State lies on disk twice, in the executors' stores and in the checkpoint.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}


def build_session(app: str = "orderloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session for batch jobs and streams. Shuffle width is left to AQE unless given in `conf`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.metricsEnabled": "true",
        # Recording the call site of every expression takes most of the time of building a plan,
        # which a micro-batch job does again for each batch.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **STATE_ON_DISK,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Day and hour buckets are defined in UTC, whatever zone the session started with."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    It lies below `spark.checkpoint.dir`, the shared folder the cluster names, and without that
    setting below the session's warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir") or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Let the shuffle files of ended jobs go. Spark deletes them when its driver collects garbage, which a
    driver with little to do hardly does by itself, so it is asked to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table_at(rows: DataFrame, path: str) -> DataFrame:
    """The rows as a table in a scratch folder, read from there from then on. What made them is of no use
    any more."""
    rows.write.option("compression", "zstd").parquet(path)
    release(rows.sparkSession)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
