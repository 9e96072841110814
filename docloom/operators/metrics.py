"""Run metrics: labelled counters, duration histograms, text snapshots and their analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions.ids import snapshot_time


def counters(events: DataFrame, *labels: str | Column) -> DataFrame:
    return events.groupBy(*labels).agg(F.count(F.lit(1)).alias("value"))


def duration_histogram(df: DataFrame, value: str, bounds: Sequence[int], *labels: str) -> DataFrame:
    """Cumulative buckets (upper bound inclusive, then +Inf) with count and sum, in one pass."""
    agg = df.groupBy(*labels).agg(
        F.count(value).alias("count"), F.round(F.sum(value), 6).alias("sum"),
        *[F.count_if(F.col(value) <= b).alias(f"b{i}") for i, b in enumerate(bounds)])
    cells = F.array(*[
        F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("cumulative")) for i, b in enumerate(bounds)
    ], F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("cumulative")))
    return agg.select(*labels, "count", "sum", F.explode(cells).alias("c")).select(
        *labels, "c.le", "c.cumulative", "count", "sum")


def format_lines(samples: DataFrame) -> DataFrame:
    """Text form of samples (name, labels map, value): ``name{k="v",…} value``."""
    pairs = F.transform(
        F.sort_array(F.map_entries("labels")),
        lambda e: F.concat(e["key"], F.lit('="'), e["value"], F.lit('"')))
    body = F.when(F.size("labels") > 0, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))).otherwise("")
    return samples.withColumn("line", F.concat("name", body, F.lit(" "), F.col("value").cast("string")))


def parse_line(line: Column) -> tuple[Column, Column]:
    """(name, value) of a sample line; nulls for comments and lines that do not fit."""
    text = F.trim(line)
    hit = text.rlike(K.METRIC_LINE) & ~F.startswith(text, F.lit("#"))
    name = F.when(hit, F.regexp_extract(text, K.METRIC_LINE, 1))
    value = F.when(hit, F.regexp_extract(text, K.METRIC_LINE, 2).try_cast("double"))
    return name, value


def sessions(files: DataFrame) -> DataFrame:
    """One row per snapshot file (path, name, text): its time and the last sample of each known metric.

    A metric is recognised by a known name inside its own, the first known name winning.
    """
    keys = [c for c in ("path", "name") if c in files.columns]
    lines = files.select(*keys, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    metric, value = parse_line(F.col("line"))
    known = None
    for m in K.SESSION_METRICS:
        cond = F.contains(F.lower("metric"), F.lit(m))
        known = F.when(cond, m) if known is None else known.when(cond, m)
    samples = lines.select(*keys, "pos", metric.alias("metric"), value.alias("value")).withColumn("known", known)
    picked = samples.groupBy(*keys).agg(*[
        F.coalesce(
            F.max_by(F.when(F.col("known") == m, F.col("value")), F.when(F.col("known") == m, F.col("pos"))),
            F.lit(0.0),
        ).alias(m)
        for m in K.SESSION_METRICS
    ])
    # Two further fields exist in the session record but no sample line feeds them.
    return picked.select(
        "name", snapshot_time(F.col("name")).alias("timestamp"), *K.SESSION_METRICS,
        F.lit(0.0).alias("requests_success"), F.lit(0.0).alias("requests_failure"))


def busy_sessions(df: DataFrame) -> DataFrame:
    return df.filter(F.col("documents_processed_total") > 1).orderBy("timestamp")
