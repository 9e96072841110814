"""Relational scans over Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.session import spread


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def load_texts(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A text table read for heavy per-row work: only the columns needed, spread over the cores."""
    df = load(spark, folder, name)
    return spread(df.select(*columns) if columns else df)
