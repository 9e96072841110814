"""Run-metric queries: the event log stands in for the recorders."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import constants as K
from docloom.operators import metrics as X
from docloom.plans.registry import query
from docloom.session import shared_dir
from docloom.sources import snapshots as snap
from docloom.sources.tables import load


@query("labelled_counters", """SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, count(*)::BIGINT AS value FROM events GROUP BY ALL""")
def labelled_counters(spark, sf):
    return X.counters(load(spark, sf, "events"), "event_type", F.date_format("ts", "yyyy-MM-dd").alias("date"))


def _hist_sql(bounds):
    rows = ", ".join(f"({b}::DOUBLE, '{b}')" for b in bounds)
    return f"""SELECT event_type, le, count(*) FILTER (WHERE value <= b)::BIGINT AS cumulative, count(value)::BIGINT AS count, round(sum(value), 6) AS sum
FROM events, (VALUES {rows}, ('infinity'::DOUBLE, '+Inf')) v(b, le) GROUP BY ALL"""


@query("duration_histogram", _hist_sql(K.DOCUMENT_BUCKETS))
def duration_histogram(spark, sf):
    return X.duration_histogram(load(spark, sf, "events"), "value", K.DOCUMENT_BUCKETS, "event_type")


@query("day_duration_histogram", _hist_sql(K.DAY_BUCKETS))
def day_duration_histogram(spark, sf):
    return X.duration_histogram(load(spark, sf, "events"), "value", K.DAY_BUCKETS, "event_type")


# Metric names the event kinds are recorded under.
METRIC_OF = {
    "view": "corpus_documents_processed_total", "click": "corpus_requests_total",
    "signup": "corpus_retry_attempts_total", "error": "corpus_validation_errors_total",
    "purchase": "corpus_storage_size_bytes",
}


def samples(spark, sf):
    """One snapshot per day: events per kind and tenth of users, as labelled counter samples."""
    metric = F.create_map(*[F.lit(x) for kv in METRIC_OF.items() for x in kv])
    return (
        load(spark, sf, "events")
        .groupBy(F.concat(F.lit("metrics_"), F.date_format("ts", "yyyyMMdd"), F.lit("_000000.prom")).alias("snapshot"),
                 F.element_at(metric, F.col("event_type")).alias("name"), (F.col("user_id") % 10).alias("shard"))
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
        .withColumn("labels", F.create_map(F.lit("shard"), F.col("shard").cast("string")))
    )


def sample_lines(spark, sf):
    lines = X.format_lines(samples(spark, sf))
    pos = F.col("shard") + 1
    comments = lines.select("snapshot", F.lit(0).cast("long").alias("pos"),
                            F.concat(F.lit("# HELP "), F.col("name"), F.lit(" x")).alias("line")).distinct()
    return lines.select("snapshot", pos.alias("pos"), "line").unionByName(comments)


@query("metric_lines", """WITH c AS (SELECT strftime(ts, 'metrics_%Y%m%d_000000.prom') AS snapshot,
  CASE event_type WHEN 'view' THEN 'corpus_documents_processed_total' WHEN 'click' THEN 'corpus_requests_total'
   WHEN 'signup' THEN 'corpus_retry_attempts_total' WHEN 'error' THEN 'corpus_validation_errors_total' ELSE 'corpus_storage_size_bytes' END AS name,
  user_id % 10 AS shard, count(*) AS n FROM events GROUP BY ALL)
SELECT snapshot, name || '{shard="' || shard || '"} ' || n || '.0' AS line, name AS metric, n::DOUBLE AS value FROM c
UNION ALL SELECT DISTINCT snapshot, '# HELP ' || name || ' x', NULL, NULL FROM c""")
def metric_lines(spark, sf):
    name, value = X.parse_line(F.col("line"))
    return sample_lines(spark, sf).select("snapshot", "line", name.alias("metric"), value.alias("value"))


@query("metric_sessions", """WITH c AS (SELECT strftime(ts, '%Y%m%d') AS day, event_type, user_id % 10 AS shard, count(*)::DOUBLE AS n FROM events GROUP BY ALL),
l AS (SELECT day, event_type, arg_max(n, shard) AS n FROM c GROUP BY ALL),
p AS (SELECT day, coalesce(max(n) FILTER (WHERE event_type = 'view'), 0) AS documents_processed_total,
  coalesce(max(n) FILTER (WHERE event_type = 'click'), 0) AS requests_total,
  coalesce(max(n) FILTER (WHERE event_type = 'signup'), 0) AS retry_attempts_total,
  coalesce(max(n) FILTER (WHERE event_type = 'error'), 0) AS validation_errors_total,
  coalesce(max(n) FILTER (WHERE event_type = 'purchase'), 0) AS storage_size_bytes FROM l GROUP BY day)
SELECT 'metrics_' || day || '_000000' AS name, strftime(strptime(day, '%Y%m%d'), '%Y-%m-%d %H:%M:%S') AS timestamp, documents_processed_total,
  requests_total, retry_attempts_total, validation_errors_total, storage_size_bytes, 0::DOUBLE AS requests_success, 0::DOUBLE AS requests_failure
FROM p WHERE documents_processed_total > 1""")
def metric_sessions(spark, sf):
    """Write the daily snapshots as text, read them back, keep the last sample per metric."""
    path = shared_dir(spark, "snapshots")
    snap.write_snapshots(sample_lines(spark, sf), path)
    return X.busy_sessions(X.sessions(snap.read_snapshots(spark, path))).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("storage_size", "SELECT sum(strlen(event_type) + 1)::BIGINT AS n_bytes FROM events")
def storage_size(spark, sf):
    """Bytes of a stored folder: the event kinds as text, partitioned by day."""
    path = shared_dir(spark, "storage")
    events = load(spark, sf, "events").select(F.date_format("ts", "yyyyMMdd").alias("day"), F.col("event_type").alias("value"))
    events.hint("rebalance", "day").write.partitionBy("day").text(path)
    return snap.storage_bytes(spark, path).select("n_bytes")
