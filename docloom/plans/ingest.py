"""Ingest queries: ids, dates, validation, request plans, copies, stored files."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import ids as I
from docloom.operators import dedup as D
from docloom.operators import star as S
from docloom.operators import validation as V
from docloom.plans.registry import query
from docloom.plans.star import document_records
from docloom.session import shared_dir
from docloom.sources import documents as store
from docloom.sources.export import export_csv
from docloom.sources.tables import load, load_texts

BASE_URL = "https://example.org"


@query("date_range_plan", f"""WITH r AS (
  SELECT 'user ' || user_id AS request, min(ts)::DATE AS s, max(ts)::DATE AS e FROM events GROUP BY user_id
  UNION ALL SELECT 'customer ' || o_custkey, min(o_orderdate)::DATE, max(o_orderdate)::DATE FROM orders GROUP BY o_custkey),
d AS (SELECT request, unnest(generate_series(s::TIMESTAMP, e::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM r WHERE s >= DATE '2023-10-02' AND e >= s)
SELECT request, strftime(day, '%Y-%m-%d') AS day, '{BASE_URL}/oj/daily-view/L-series/default.html?ojDate=' || strftime(day, '%d%m%Y') AS url,
       strftime(day, '%Y%m%d') AS journal_id FROM d""")
def date_range_plan(spark, sf):
    """Every user's active period is a request; the customers' lie before the first day and are refused."""
    users = load(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").cast("date").alias("start"), F.max("ts").cast("date").alias("end")
    ).select(F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("request"), "start", "end")
    customers = load(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end")
    ).select(F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("request"), "start", "end")
    return V.date_range_plan(users.unionByName(customers), BASE_URL)


RAW_ID_SQL = """CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN 'L_2024' || o_orderkey
  ELSE 'L_' || strftime(o_orderdate, '%Y') || lpad(((o_orderkey * 7) % 100000)::VARCHAR, 5, '0') END"""


def _raw_ids(spark, sf):
    k = F.col("o_orderkey")
    raw = (
        F.when(k % 11 == 0, "")
        .when(k % 7 == 0, F.concat(F.lit("L_2024"), k.cast("string")))
        .otherwise(F.concat(F.lit("L_"), F.date_format("o_orderdate", "yyyy"), F.lpad(((k * 7) % 100000).cast("string"), 5, "0")))
    )
    return load(spark, sf, "orders").select("o_orderkey", raw.alias("raw_id"))


@query("valid_doc_ids", f"""WITH r AS (SELECT o_orderkey, {RAW_ID_SQL} AS raw_id FROM orders),
b AS (SELECT *, regexp_replace(raw_id, '^L_', '') AS b FROM r)
SELECT o_orderkey, raw_id, length(b) = 9 AND substr(b, 5, 1) <> '9' AND regexp_matches(b, '^[0-9]{{4}}') AS is_valid,
       '{BASE_URL}/legal-content/EN/TXT/?uri=OJ:L_' || b AS url FROM b""")
def valid_doc_ids(spark, sf):
    bare = F.regexp_replace("raw_id", "^L_", "")
    return _raw_ids(spark, sf).select(
        "o_orderkey", "raw_id", I.valid_document_id(F.col("raw_id")).alias("is_valid"),
        I.document_url(BASE_URL, bare, "TXT").alias("url"))


DATE_TEXT_SQL = """CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%d.%m.%Y')
  WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN 'No end date' WHEN 4 THEN '31/02/2024' ELSE NULL END"""


@query("parse_dates", f"""SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE WHEN o_orderkey % 6 = 2 THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00') END AS moment FROM (
  SELECT *, {DATE_TEXT_SQL} AS raw FROM orders)""")
def parse_dates(spark, sf):
    k = F.col("o_orderkey") % 6
    raw = (
        F.when(k == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(k == 1, F.date_format("o_orderdate", "dd.MM.yyyy"))
        .when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(k == 3, "No end date").when(k == 4, "31/02/2024")
    )
    df = load(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return df.select(
        "o_orderkey", F.date_format(I.parse_date(F.col("raw")), "yyyy-MM-dd").alias("day"),
        F.date_format(I.parse_timestamp(F.col("raw")), "yyyy-MM-dd HH:mm:ss").alias("moment"))


SHAPES = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "MM/dd/yyyy", "dd.MM.yyyy", "dd MMMM yyyy", "MMM dd, yyyy")


@query("coerced_timestamps", """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 8 THEN NULL WHEN o_orderkey % 9 = 7 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 14:05:00'
  ELSE strftime(o_orderdate, '%Y-%m-%d 00:00:00') END AS moment FROM orders""")
def coerced_timestamps(spark, sf):
    """Dates in seven shapes, one with a time, and texts that are no dates."""
    k = F.col("o_orderkey") % 9
    raw = F.when(k == 7, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T14:05")))
    for i, shape in enumerate(SHAPES):
        raw = raw.when(k == i, F.date_format("o_orderdate", shape))
    raw = raw.otherwise(F.concat(F.lit("no date "), F.col("o_orderkey").cast("string")))
    return load(spark, sf, "orders").select("o_orderkey", F.date_format(I.coerced_timestamp(raw), "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query("metadata_validation", """SELECT o_orderkey,
  CASE WHEN o_orderkey % 13 = 0 THEN 'title' WHEN o_orderkey % 17 = 0 THEN 'title' ELSE '' END AS errors,
  CASE o_orderkey % 4 WHEN 0 THEN 'A/' || strftime(o_orderdate, '%Y') || '/' || o_orderkey WHEN 1 THEN 'B/2024/' || o_orderkey || '/XYZ' ELSE '' END AS identifier
FROM orders""")
def metadata_validation(spark, sf):
    """Records with missing and empty titles and with identifiers in and out of the pattern."""
    k = F.col("o_orderkey")
    meta = F.struct(
        F.concat(F.lit("3"), k.cast("string")).alias("celex_number"),
        F.when(k % 13 == 0, F.lit(None)).when(k % 17 == 0, "").otherwise("Title").alias("title"),
        F.when(k % 4 == 0, F.concat(F.lit(" A/"), F.date_format("o_orderdate", "yyyy"), F.lit("/"), k.cast("string"), F.lit(" ")))
        .when(k % 4 == 1, F.concat(F.lit("B/2024/"), k.cast("string"), F.lit("/XYZ")))
        .when(k % 4 == 2, "ST/11940/2023/INIT").otherwise("INVALID FORMAT").alias("identifier"),
    )
    df = load(spark, sf, "orders").select("o_orderkey", meta.alias("metadata"))
    return V.validate(df).select("o_orderkey", F.array_join("errors", ",").alias("errors"), "metadata.identifier")


RAW_SQL = """CASE o_orderkey % 8 WHEN 0 THEN '{"celex_number": ' || o_orderkey || ', "title": "T"}'
  WHEN 1 THEN '{"celex_number": "3", "title": ["T"], "form": null}' WHEN 2 THEN '{"celex_number": "3", "title": "T", "authors": "A"}'
  WHEN 3 THEN '{"title": "T", "authors": ["A", 1], "subject_matters": []}' WHEN 4 THEN '{"dates": {"Date of document": 20240101, "Date of effect": "x"}}'
  WHEN 5 THEN 'no json ' || o_orderkey WHEN 6 THEN '["' || o_orderkey || '"]' ELSE '{"celex_number": "3", "title": "T", "authors": ["A", "B"]}' END"""


@query("metadata_types", """SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'celex_number' WHEN 1 THEN 'title,form' WHEN 2 THEN 'authors' WHEN 3 THEN 'authors'
  WHEN 4 THEN 'dates.Date of document' WHEN 5 THEN 'record' WHEN 6 THEN 'record' ELSE '' END AS errors FROM orders""")
def metadata_types(spark, sf):
    """Raw records with fields of wrong types, lists of mixed types, and texts that are no records."""
    raw = load(spark, sf, "orders").select("o_orderkey", F.expr(RAW_SQL).alias("raw"))
    return raw.select("o_orderkey", F.array_join(V.type_errors(F.col("raw")), ",").alias("errors"))


@query("single_file_scan", """SELECT 'S' || s_suppkey AS celex_number, 'About ' || s_name AS title, 'Text of ' || s_name AS content FROM supplier""")
def single_file_scan(spark, sf):
    """One JSON file per document, written and scanned back; a number that comes twice is one document."""
    path = shared_dir(spark, "json-files")
    meta = F.struct(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("celex_number"),
                    F.concat(F.lit("About "), F.col("s_name")).alias("title"))
    rows = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("file"), meta.alias("metadata"),
                                              F.concat(F.lit("Text of "), F.col("s_name")).alias("content"))
    store.write_single_files(rows, "file", path)
    return store.scan_single_files(spark, path).select("metadata.celex_number", "metadata.title", "content")


@query("report_export", "SELECT source, count(*)::BIGINT AS n_docs, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY source")
def report_export(spark, sf):
    """A report written as CSV with a header and read back."""
    path = shared_dir(spark, "report")
    report = load(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("n_chars"))
    export_csv(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


@query("column_backfill", "SELECT doc_id, n_chars, lang || '/' || source AS label FROM documents")
def column_backfill(spark, sf):
    """A column that is missing is added, one that is there is left alone."""
    docs = load(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    docs = S.add_missing_column(docs, "label", F.concat_ws("/", "lang", "source"))
    return S.add_missing_column(docs, "n_chars", F.lit(-1)).select("doc_id", "n_chars", "label")


PATH_SQL = """'data/2024/' || CASE WHEN doc_id % 9 = 0 THEN 'misc' WHEN doc_id % 10 = 3 THEN '20240230'
  ELSE '202401' || lpad(((doc_id * 37) % 28 + 1)::VARCHAR, 2, '0') END || '/' || doc_id || '.json'"""


def stored_files(spark, sf):
    """A file listing: the text digest is the key, so exact copies share it."""
    d = F.col("doc_id")
    folder = (
        F.when(d % 9 == 0, "misc").when(d % 10 == 3, "20240230")
        .otherwise(F.concat(F.lit("202401"), F.lpad(((d * 37) % 28 + 1).cast("string"), 2, "0")))
    )
    path = F.concat(F.lit("data/2024/"), folder, F.lit("/"), d.cast("string"), F.lit(".json"))
    return load_texts(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", F.md5("text").alias("celex_number"), path.alias("path"))


@query("path_dates", f"""SELECT doc_id, path, CASE WHEN doc_id % 9 = 0 OR doc_id % 10 = 3 THEN NULL
  ELSE '2024-01-' || lpad(((doc_id * 37) % 28 + 1)::VARCHAR, 2, '0') END AS day FROM (SELECT doc_id, {PATH_SQL} AS path FROM documents)""")
def path_dates(spark, sf):
    return stored_files(spark, sf).select(
        "doc_id", "path", F.date_format(I.path_date(F.col("path")), "yyyy-MM-dd").alias("day"))


DEDUP_SQL = f"""WITH f AS (SELECT doc_id, md5(text) AS celex_number, {PATH_SQL} AS path,
  CASE WHEN doc_id % 9 = 0 OR doc_id % 10 = 3 THEN NULL ELSE (doc_id * 37) % 28 + 1 END AS day FROM documents),
r AS (SELECT *, CASE WHEN day IS NULL THEN 'unparsed' WHEN row_number() OVER (PARTITION BY celex_number, day IS NULL ORDER BY day, path) = 1
  THEN 'keep' ELSE 'duplicate' END AS status FROM f)"""


@query("dedup_keep_earliest", f"{DEDUP_SQL} SELECT doc_id, celex_number, path, status FROM r")
def dedup_keep_earliest(spark, sf):
    return D.keep_earliest(stored_files(spark, sf), "celex_number").select("doc_id", "celex_number", "path", "status")


@query("dedup_backup", f"""{DEDUP_SQL} SELECT doc_id, 'backup/' || replace(path, 'data/', '') AS backup_path FROM r WHERE status = 'duplicate'""")
def dedup_backup(spark, sf):
    marked = D.keep_earliest(stored_files(spark, sf), "celex_number")
    return D.backup_plan(marked, "data", "backup").select("doc_id", "backup_path")


@query("document_exists_semi", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def document_exists_semi(spark, sf):
    return store.existing(load(spark, sf, "documents").select("doc_id", "lang"), load(spark, sf, "labels"), "doc_id")


@query("unprocessed_documents", """SELECT doc_id, lang FROM documents WHERE text IS NOT NULL
AND doc_id NOT IN (SELECT doc_id FROM labels)""")
def unprocessed_documents(spark, sf):
    docs = load(spark, sf, "documents").filter(F.col("text").isNotNull()).select("doc_id", "lang")
    return D.unseen(docs, load(spark, sf, "labels"), "doc_id")


@query("seen_set_union", "SELECT doc_id FROM labels UNION SELECT doc_id FROM documents")
def seen_set_union(spark, sf):
    return D.grow_seen(load(spark, sf, "labels"), load(spark, sf, "documents"), "doc_id")


@query("json_roundtrip", """SELECT '3' || strftime(o_orderdate, '%Y') || 'R' || lpad(o_orderkey::VARCHAR, 9, '0') AS celex_number,
  strftime(o_orderdate, '%d/%m/%Y') AS date_of_document, 3::INT AS n_authors,
  CASE WHEN o_orderkey % 2 = 0 THEN 'revised ' ELSE '' END || 'Text of ' || o_orderkey AS content FROM orders""")
def json_roundtrip(spark, sf):
    """Store all records, replace every second one by an upsert, scan the tree back."""
    path = shared_dir(spark, "json-store")
    records = document_records(spark, sf).withColumn("doc_id", F.col("metadata.celex_number"))
    day = I.parse_date(F.element_at("metadata.dates", "Date of document"))
    records = store.with_partitions(records, day, F.date_format(day, "yyyyMM"))
    store.store(records.unionByName(records.filter(F.col("metadata.celex_number").isNotNull())), path)
    even = records.filter(F.regexp_extract("content", "([0-9]+)$", 1).cast("long") % 2 == 0)
    store.store(even.withColumn("content", F.concat(F.lit("revised "), F.col("content"))), path)
    return store.scan_tree(spark, path).select(
        "metadata.celex_number", F.element_at("metadata.dates", "Date of document").alias("date_of_document"),
        F.size("metadata.authors").alias("n_authors"), "content")


@query("processing_progress", """SELECT count(*)::BIGINT AS total, count(quality)::BIGINT AS processed,
  count(*) FILTER (WHERE quality = 1)::BIGINT AS succeeded, count(*) FILTER (WHERE quality = 0)::BIGINT AS failed
FROM documents LEFT JOIN labels USING (doc_id)""")
def processing_progress(spark, sf):
    j = load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels"), "doc_id", "left")
    return j.agg(F.count(F.lit(1)).alias("total"), F.count("quality").alias("processed"),
                 F.count_if(F.col("quality") == 1).alias("succeeded"),
                 F.count_if(F.col("quality") == 0).alias("failed"))
