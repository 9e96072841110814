"""Streaming queries, run to completion over what has arrived."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import ingest as J
from docloom.plans.pages import BASE_URL, metadata_pages
from docloom.plans.registry import query
from docloom.session import shared_dir
from docloom.sources import documents as store
from docloom.sources.tables import load, load_texts
from docloom.streaming import counters as C
from docloom.streaming import ingest as I


@query("incremental_ingest", "SELECT md5(text) AS celex_number, any_value(length(text))::BIGINT AS n_chars FROM documents GROUP BY 1")
def incremental_ingest(spark, sf):
    """Documents arrive twice, in two folders; the stream stores every key once, in folders by a hash of the key."""
    arrivals, work = shared_dir(spark, "arrivals"), shared_dir(spark, "ingest")
    docs = load_texts(spark, sf, "documents", "doc_id", "text").select(
        F.struct(F.md5("text").alias("celex_number"), F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title")).alias("metadata"),
        F.col("text").alias("content"), "doc_id")
    docs.drop("doc_id").write.json(f"{arrivals}/first")
    I.ingest(spark, arrivals, f"{work}/table", f"{work}/checkpoint", 5, buckets=32)
    docs.filter(F.col("doc_id") % 2 == 0).drop("doc_id").write.json(f"{arrivals}/second")
    table = I.ingest(spark, arrivals, f"{work}/table", f"{work}/checkpoint", 5, buckets=32)
    return table.select("celex_number", F.length("content").cast("long").alias("n_chars"))


@query("stream_counters", "SELECT event_type, user_id, count(*)::BIGINT AS value FROM events GROUP BY ALL")
def stream_counters(spark, sf):
    """The events arrive in four files and are counted one by one; every batch changes some of the label sets."""
    work = shared_dir(spark, "counters")
    load(spark, sf, "events").repartition(4, "user_id").write.parquet(f"{work}/events")
    return C.running_counters(spark, f"{work}/events", "*.parquet", f"{work}/table", f"{work}/checkpoint", "event_type", "user_id", files_per_batch=1)


def run_ingest(spark, sf):
    """A metadata page and a text page for every order; some pages are broken, some keys are stored already."""
    k = F.col("o_orderkey").cast("string")
    box = F.when(F.col("o_orderkey") % 23 == 0, "other").otherwise("TexteOnly")
    text = F.concat(F.lit('<html><body><div id="'), box, F.lit('"><p>Text of '), k, F.lit("</p></div></body></html>"))
    pages = metadata_pages(spark, sf, "o_orderdate").withColumnRenamed("html", "meta_html").select(
        "o_orderkey", "o_orderdate", "meta_html", text.alias("text_html"), F.concat(F.lit("2024"), F.lpad(k, 8, "0")).alias("source_id"))
    seen = load(spark, sf, "orders").filter(F.col("o_orderkey") % 4 == 0).select(
        F.concat(F.lit("3"), F.date_format("o_orderdate", "yyyy"), F.lit("R"), k).alias("celex_number"))
    return J.ingest(pages, seen, shared_dir(spark, "ingested-store"), BASE_URL, F.col("o_orderdate"), F.date_format("o_orderdate", "yyyy-MM"), doc_id="source_id")


OUTCOME_SQL = """o AS (SELECT o_orderkey, o_orderdate, '3' || strftime(o_orderdate, '%Y') || 'R' || o_orderkey AS celex_number, strftime(o_orderdate, '%Y-%m') AS journal,
  CASE WHEN o_orderkey % 19 = 0 THEN 'metadata failed' WHEN o_orderkey % 4 = 0 THEN 'already stored' WHEN o_orderkey % 23 = 0 THEN 'text failed' ELSE 'success' END AS status FROM orders)"""


@query("ingest_batch", f"""WITH {OUTCOME_SQL} SELECT journal, status, count(*)::BIGINT AS n_docs,
  sum(CASE WHEN status = 'success' THEN length('Text of ' || o_orderkey) ELSE 0 END)::BIGINT AS n_chars FROM o GROUP BY ALL""")
def ingest_batch(spark, sf):
    """The outcome per journal and status of a run that stores its records."""
    rows = run_ingest(spark, sf).outcomes.select(F.col("journal_id").alias("journal"), "status", "n_chars")
    return rows.groupBy("journal", "status").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").cast("long").alias("n_chars"))


@query("ingest_records", f"""WITH {OUTCOME_SQL} SELECT celex_number, 'Order & text ' || o_orderkey AS title,
  '{BASE_URL}/legal-content/EN/TXT/?uri=OJ:L_2024' || lpad(o_orderkey::VARCHAR, 8, '0') AS html_url,
  '{BASE_URL}/legal-content/EN/TXT/PDF/?uri=OJ:L_2024' || lpad(o_orderkey::VARCHAR, 8, '0') AS pdf_url,
  strftime(o_orderdate, '%d/%m/%Y') AS date_of_document, 'Text of ' || o_orderkey AS content FROM o WHERE status = 'success'""")
def ingest_records(spark, sf):
    """The records that a run stored, read back from the store."""
    rows = store.scan_tree(spark, run_ingest(spark, sf).path)
    return rows.select("metadata.celex_number", "metadata.title", "metadata.html_url", "metadata.pdf_url",
                       F.element_at("metadata.dates", "Date of document").alias("date_of_document"), "content")
