"""Export of small report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Report with a header row.  One file only on request, for aggregated tables."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
