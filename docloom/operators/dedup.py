"""Resolution of several stored copies of one document, and the set of seen keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.ids import path_date


def keep_earliest(files: DataFrame, key: str, path: str = "path") -> DataFrame:
    """Marks every file keep, duplicate or unparsed (no date in its path, or no key: left alone).

    The winner of a key is the smallest (date, path), a map-side combined minimum, and is found
    again by its path.  A key with a third of all copies therefore costs one row per task in
    the shuffle, and the join key is unique.
    """
    dated = files.withColumn("_date", path_date(F.col(path)))
    winners = (
        dated.filter(F.col("_date").isNotNull() & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(F.col("_date"), F.col(path))).alias("_best"))
        .select(F.col(f"_best.{path}").alias(path), F.lit(True).alias("_won"))
    )
    status = (
        F.when(F.col("_date").isNull() | F.col(key).isNull(), "unparsed")
        .when(F.col("_won"), "keep")
        .otherwise("duplicate")
    )
    return dated.join(winners, path, "left").withColumn("status", status).drop("_date", "_won")


def backup_plan(marked: DataFrame, data_dir: str, backup_dir: str, path: str = "path") -> DataFrame:
    """Where each duplicate goes: the same relative path below the backup folder."""
    relative = F.regexp_replace(path, "^" + data_dir.rstrip("/") + "/", "")
    return marked.filter(F.col("status") == "duplicate").withColumn(
        "backup_path", F.concat(F.lit(backup_dir.rstrip("/") + "/"), relative))


def unseen(docs: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return docs.join(seen.select(key), key, "left_anti")


def grow_seen(seen: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return seen.select(key).union(new.select(key)).distinct()
