"""Session defaults, shared storage and input spreading."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "docloom", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the jobs rely on; every one can be overridden by keyword."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # Large column expressions are built in a fraction of the time without call-site capture.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    The folder is read from ``spark.checkpoint.dir``; where that is unset, the warehouse, which
    driver and executors share as well, takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Cut lineage through a written Parquet table that survives the loss of executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_key(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition by key ahead of work that multiplies the rows.

    The number of partitions is given, so adaptive execution does not merge them by the small
    size of the input; it is the session's shuffle setting, raised to the number of slots.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, key)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan over the cores when it has fewer splits than the cluster has slots.

    A large table arrives in far more splits than slots and passes through untouched, so the
    text column is never shuffled at scale; a one-file table would otherwise run in one task.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * slots:
        return df
    return df.repartition(slots, *keys) if keys else df.repartition(slots)
