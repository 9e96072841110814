"""Text snapshots of run metrics: one folder per snapshot, named metrics_yyyyMMdd_HHmmss."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_NAME = r"(metrics_[0-9]{8}_[0-9]{6})[^/]*"


def write_snapshots(lines: DataFrame, path: str) -> None:
    """lines(snapshot, pos, line); a snapshot is a handful of lines and becomes one small file."""
    lines.repartition("snapshot").sortWithinPartitions("snapshot", "pos").select(
        "snapshot", F.col("line").alias("value")).write.mode("overwrite").partitionBy("snapshot").text(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, text) per snapshot file, found at any depth.

    The path is the file's own, so equal names in two folders stay apart; the name is the last
    part of it that is named as a snapshot, or else the file name.
    """
    return (
        spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
        .select("path", F.coalesce(F.nullif(F.regexp_extract("path", f".*{SNAPSHOT_NAME}", 1), F.lit("")),
                                   F.substring_index("path", "/", -1)).alias("name"), "text")
    )


def storage_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Number and total size of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("length")
        .agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"))
    )
