"""Star-schema queries.

documents: form is the source, body the language.  orders and lineitem stand in for the linked
documents: suppliers are authors, part types subjects, part names descriptors, brands directory
codes, and the order status is the form.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import star as S
from docloom.plans.registry import query
from docloom.sources.tables import load

BODIES = ("en", "fr", "de", "es")


def facts(spark, sf):
    """Fact table and its two lookups, keyed by their names."""
    docs = load(spark, sf, "documents").select(
        "doc_id", "n_chars", F.col("source").alias("form_id"), F.col("lang").alias("responsible_body_id"))
    base = load(spark, sf, "documents")
    forms = S.natural_dimension(base, F.array("source"), "form_id", "form_name")
    bodies = S.natural_dimension(base, F.array("lang"), "responsible_body_id", "body_name")
    return docs, forms, bodies


@query("docs_enriched", "SELECT doc_id, n_chars, source AS form, lang AS responsible_body FROM documents")
def docs_enriched(spark, sf):
    docs, forms, bodies = facts(spark, sf)
    return S.enrich(docs, forms, bodies).select(
        "doc_id", "n_chars", F.col("form_name").alias("form"), F.col("body_name").alias("responsible_body"))


@query("docs_by_form", "SELECT source AS form, count(doc_id)::BIGINT AS doc_count FROM documents GROUP BY source")
def docs_by_form(spark, sf):
    docs, forms, _ = facts(spark, sf)
    return S.count_by_lookup(docs, forms, "form_id", "form_name", "doc_id").withColumnRenamed("form_name", "form")


@query("docs_by_body", "SELECT lang AS responsible_body, count(doc_id)::BIGINT AS doc_count FROM documents GROUP BY lang")
def docs_by_body(spark, sf):
    docs, _, bodies = facts(spark, sf)
    return S.count_by_lookup(docs, bodies, "responsible_body_id", "body_name", "doc_id").withColumnRenamed(
        "body_name", "responsible_body")


@query("top_bodies", """SELECT lang AS responsible_body, count(doc_id)::BIGINT AS doc_count FROM documents
GROUP BY lang ORDER BY 2 DESC, 1 LIMIT 10""")
def top_bodies(spark, sf):
    return S.top(docs_by_body(spark, sf), 10, "doc_count", "responsible_body")


@query("form_by_body", """SELECT source AS form, lang AS responsible_body, count(*)::BIGINT AS cnt FROM documents GROUP BY ALL""")
def form_by_body(spark, sf):
    docs, forms, bodies = facts(spark, sf)
    counts = docs.groupBy("form_id", "responsible_body_id").agg(F.count("doc_id").alias("cnt"))
    return S.enrich(counts, forms, bodies).select(
        F.col("form_name").alias("form"), F.col("body_name").alias("responsible_body"), "cnt")


@query("pivot_form_body", "SELECT source AS form, " + ", ".join(
    f"count(*) FILTER (WHERE lang = '{b}')::BIGINT AS {b}" for b in BODIES) + " FROM documents GROUP BY source")
def pivot_form_body(spark, sf):
    return S.pivot_counts(form_by_body(spark, sf), "form", "responsible_body", BODIES, "cnt")


@query("body_frequency", """SELECT CASE WHEN quality IS NULL THEN 'unknown' ELSE quality::VARCHAR END AS value, count(*)::BIGINT AS n
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def body_frequency(spark, sf):
    """Frequency with the null value kept, shown as 'unknown'; quality labels are the value."""
    df = load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels"), "doc_id", "left")
    return df.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).select(
        F.coalesce(F.col("quality").cast("string"), F.lit("unknown")).alias("value"), "n")


def _labelled(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang", F.col("source").alias("form"))
    return docs.join(load(spark, sf, "labels"), "doc_id", "left")


@query("missing_report", "WITH j AS (SELECT doc_id, lang, source AS form, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))\n"
       + "\nUNION ALL\n".join(
           f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS missing,
  round(count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS percent FROM j"""
           for c in ("doc_id", "lang", "form", "quality", "toxic")))
def missing_report(spark, sf):
    return S.missing_report(_labelled(spark, sf))


@query("missing_by_form", """SELECT source AS form, round(avg((quality IS NULL)::INT), 6) AS missing_share
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def missing_by_form(spark, sf):
    return S.missing_share(_labelled(spark, sf), "quality", "form")


@query("describe_columns", "\nUNION ALL\n".join(
    f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS type, count({c})::BIGINT AS n_values FROM documents"""
    for i, (c, t) in enumerate((("doc_id", "bigint"), ("text", "string"), ("lang", "string"),
                                ("source", "string"), ("n_chars", "bigint")))))
def describe_columns(spark, sf):
    return S.column_inventory(load(spark, sf, "documents"))


@query("row_count", "SELECT count(*)::BIGINT AS n_docs FROM documents")
def row_count(spark, sf):
    return load(spark, sf, "documents").agg(F.count(F.lit(1)).alias("n_docs"))


@query("duplicate_keys", """SELECT md5(text) AS celex_number, count(*)::BIGINT AS n_docs FROM documents
GROUP BY 1 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    """The text digest stands in for the natural key; only digests are shuffled."""
    return load(spark, sf, "documents").groupBy(F.md5("text").alias("celex_number")).agg(
        F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") > 1)


@query("duplicate_count", "SELECT (count(*) - count(DISTINCT md5(text)))::BIGINT AS n_duplicates FROM documents")
def duplicate_count(spark, sf):
    return load(spark, sf, "documents").groupBy(F.md5("text").alias("k")).agg(
        F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


# --- linked documents ------------------------------------------------------------------------


def authors_of(spark, sf):
    links = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("document_id"), F.col("l_suppkey").alias("author_id")).distinct()
    dim = load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("author_id"), F.col("s_name").alias("author_name"))
    return links, dim


def part_links(spark, sf, column, name):
    """Distinct (document, value) links through the part of each line."""
    parts = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col(column).alias(name))
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return lines.join(parts, "l_partkey").select(F.col("l_orderkey").alias("document_id"), name).distinct()


def part_dimension(spark, sf, column, id_name, name):
    return S.natural_dimension(load(spark, sf, "part"), F.array(column), id_name, name)


def part_counts(spark, sf, column, name):
    key = f"{name}_id"
    links = part_links(spark, sf, column, name).select("document_id", F.col(name).alias(key))
    return S.count_by_member(links, part_dimension(spark, sf, column, key, name), key, name, "document_id").drop(key)


@query("top_authors", """SELECT s_name AS author_name, count(l_orderkey)::BIGINT AS doc_count
FROM supplier JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) ON s_suppkey = l_suppkey
GROUP BY s_suppkey, s_name ORDER BY 2 DESC, 1 LIMIT 10""")
def top_authors(spark, sf):
    links, dim = authors_of(spark, sf)
    counts = S.count_by_member(links, dim, "author_id", "author_name", "document_id").drop("author_id")
    return S.top(counts, 10, "doc_count", "author_name")


@query("author_counts", """SELECT s_name AS author_name, count(l_orderkey)::BIGINT AS doc_count
FROM supplier JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) ON s_suppkey = l_suppkey GROUP BY s_suppkey, s_name""")
def author_counts(spark, sf):
    links, dim = authors_of(spark, sf)
    return S.count_by_member(links, dim, "author_id", "author_name", "document_id").drop("author_id").orderBy(
        F.desc("doc_count"), "author_name")


def _part_sql(column, name, tail=""):
    return f"""SELECT {column} AS {name}, count(*)::BIGINT AS doc_count FROM (
  SELECT DISTINCT l_orderkey, {column} FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1 {tail}"""


@query("top_descriptors", _part_sql("p_name", "descriptor_name", "ORDER BY 2 DESC, 1 LIMIT 10"))
def top_descriptors(spark, sf):
    return S.top(part_counts(spark, sf, "p_name", "descriptor_name"), 10, "doc_count", "descriptor_name")


@query("subject_counts", _part_sql("p_type", "subject_name"))
def subject_counts(spark, sf):
    return part_counts(spark, sf, "p_type", "subject_name").orderBy(F.desc("doc_count"), "subject_name")


@query("directory_counts", _part_sql("p_brand", "directory_code"))
def directory_counts(spark, sf):
    return part_counts(spark, sf, "p_brand", "directory_code").orderBy(F.desc("doc_count"), "directory_code")


@query("top_directory", _part_sql("p_brand", "directory_code", "ORDER BY 2 DESC, 1 LIMIT 10"))
def top_directory(spark, sf):
    return S.top(part_counts(spark, sf, "p_brand", "directory_code"), 10, "doc_count", "directory_code")


SUBJECT_FORM_SQL = """SELECT o_orderstatus AS form, p_type AS subject_name, count(*)::BIGINT AS doc_count FROM orders JOIN (
  SELECT DISTINCT l_orderkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey) ON o_orderkey = l_orderkey GROUP BY ALL"""


@query("subject_by_form", SUBJECT_FORM_SQL)
def subject_by_form(spark, sf):
    orders = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("document_id"), F.col("o_orderstatus").alias("form_id"))
    forms = S.natural_dimension(load(spark, sf, "orders"), F.array("o_orderstatus"), "form_id", "form")
    links = part_links(spark, sf, "p_type", "subject_name")
    counts = orders.join(links, "document_id").groupBy("form_id", "subject_name").agg(
        F.count(F.lit(1)).alias("doc_count"))
    return counts.join(forms, "form_id", "left").select("form", "subject_name", "doc_count")


@query("pivot_subject_form", f"""SELECT subject_name, """ + ", ".join(
    f"coalesce(sum(doc_count) FILTER (WHERE form = '{s}'), 0)::BIGINT AS {s}" for s in "FOP")
    + f" FROM ({SUBJECT_FORM_SQL}) GROUP BY 1")
def pivot_subject_form(spark, sf):
    return S.pivot_counts(subject_by_form(spark, sf), "subject_name", "form", ("F", "O", "P"), "doc_count")


@query("coauthor_pairs", """WITH l AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem),
p AS (SELECT a.l_suppkey AS a1, b.l_suppkey AS a2, count(*)::BIGINT AS cooccurrence_count
  FROM l a JOIN l b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey GROUP BY ALL)
SELECT s1.s_name AS author1_name, s2.s_name AS author2_name, cooccurrence_count
FROM p JOIN supplier s1 ON a1 = s1.s_suppkey JOIN supplier s2 ON a2 = s2.s_suppkey
ORDER BY cooccurrence_count DESC, a1, a2 LIMIT 10""")
def coauthor_pairs(spark, sf):
    links, dim = authors_of(spark, sf)
    best = S.top_pairs(links, "document_id", "author_id", 10)
    first = dim.select(F.col("author_id").alias("member1"), F.col("author_name").alias("author1_name"))
    second = dim.select(F.col("author_id").alias("member2"), F.col("author_name").alias("author2_name"))
    return best.join(first, "member1").join(second, "member2").select(
        "author1_name", "author2_name", F.col("pair_count").alias("cooccurrence_count"))


@query("monthly_counts", "SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*)::BIGINT AS doc_count FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1")
def monthly_counts(spark, sf):
    return S.monthly_counts(load(spark, sf, "orders"), "o_orderdate")


@query("seasonality", "SELECT month(o_orderdate)::INT AS month, count(*)::BIGINT AS doc_count FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1")
def seasonality(spark, sf):
    return S.seasonality(load(spark, sf, "orders"), "o_orderdate")


# --- schema built from document records --------------------------------------------------------


def document_records(spark, sf):
    """Document records in the JSON shape, derived from orders, their lines and parts.

    Two to four authors come from the customer's nation list; repeated authors are kept, as raw
    records may hold them.
    """
    o = load(spark, sf, "orders")
    key = F.col("o_orderkey")
    author = lambda n: F.concat(F.lit("Author "), F.pmod(F.col("o_custkey") + F.lit(n), F.lit(25)).cast("string"))
    code = F.concat_ws(".", F.format_string("%02d", F.pmod(key, F.lit(20)) + 1), F.lit("40"))
    meta = F.struct(
        F.concat(F.lit("3"), F.date_format("o_orderdate", "yyyy"), F.lit("R"), F.lpad(key.cast("string"), 9, "0")).alias("celex_number"),
        F.concat(F.lit("Order "), key.cast("string")).alias("title"),
        F.concat_ws("/", F.lit("A"), F.date_format("o_orderdate", "yyyy"), key.cast("string")).alias("identifier"),
        F.lit("").alias("eli_uri"), F.lit("").alias("html_url"), F.lit("").alias("pdf_url"),
        F.create_map(
            F.lit("Date of document"), F.date_format("o_orderdate", "dd/MM/yyyy"),
            F.lit("Date of effect"), F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(F.lit("")),
            F.lit("Date of end of validity"), F.lit("No end date"),
        ).alias("dates"),
        F.array(author(0), author(7), F.when(key % 3 == 0, author(0)).otherwise(author(3))).alias("authors"),
        F.when(key % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("Body "), F.col("o_orderpriority"))).alias("responsible_body"),
        F.col("o_orderstatus").alias("form"),
        F.array(F.concat(F.lit("Descriptor "), F.pmod(key, F.lit(11)).cast("string"))).alias("eurovoc_descriptors"),
        F.array(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("subject_matters"),
        F.array(code).alias("directory_codes"),
        F.array(F.concat(F.lit("Chapter "), code)).alias("directory_descriptions"),
    )
    return o.select(meta.alias("metadata"), F.concat(F.lit("Text of "), key.cast("string")).alias("content"))


AUTHORS_SQL = """a AS (SELECT o_orderkey AS k, unnest([(o_custkey) % 25, (o_custkey + 7) % 25,
  CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 25 ELSE (o_custkey + 3) % 25 END]) AS n FROM orders)"""


@query("star_authors", f"WITH {AUTHORS_SQL} SELECT 'Author ' || n AS name, count(DISTINCT k)::BIGINT AS doc_count FROM a GROUP BY 1")
def star_authors(spark, sf):
    t = S.star_schema(document_records(spark, sf), ("authors", "document_authors"))
    return S.count_by_member(t["document_authors"], t["authors"], "author_id", "name", "document_id").drop("author_id")


@query("star_junction", f"""WITH {AUTHORS_SQL}
SELECT DISTINCT '3' || strftime(o_orderdate, '%Y') || 'R' || lpad(k::VARCHAR, 9, '0') AS celex_number, 'Author ' || n AS name
FROM a JOIN orders ON k = o_orderkey""")
def star_junction(spark, sf):
    t = S.star_schema(document_records(spark, sf), ("documents", "authors", "document_authors"))
    return (
        t["document_authors"].join(t["documents"].select("document_id", "celex_number"), "document_id")
        .join(t["authors"], "author_id").select("celex_number", "name")
    )


@query("star_documents", """SELECT '3' || strftime(o_orderdate, '%Y') || 'R' || lpad(o_orderkey::VARCHAR, 9, '0') AS celex_number,
 o_orderstatus AS form, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Body ' || o_orderpriority END AS responsible_body,
 strftime(o_orderdate, '%Y-%m-%d') AS date_of_document,
 CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS date_of_effect, NULL::VARCHAR AS date_of_end_validity,
 'Text of ' || o_orderkey AS content FROM orders""")
def star_documents(spark, sf):
    t = S.star_schema(document_records(spark, sf), ("documents", "forms", "responsible_bodies"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return S.enrich(t["documents"], t["forms"], t["responsible_bodies"]).select(
        "celex_number", F.col("form_name").alias("form"), F.col("body_name").alias("responsible_body"),
        iso("date_of_document"), iso("date_of_effect"), iso("date_of_end_validity"), "content")


@query("star_directory", """SELECT code AS directory_code, 'Chapter ' || code AS directory_label, count(*)::BIGINT AS doc_count FROM (
  SELECT lpad(((o_orderkey % 20) + 1)::VARCHAR, 2, '0') || '.40' AS code FROM orders) GROUP BY ALL""")
def star_directory(spark, sf):
    t = S.star_schema(document_records(spark, sf), ("directory_codes", "document_directory_codes"))
    counts = S.count_by_member(t["document_directory_codes"], t["directory_codes"], "directory_id",
                               "directory_code", "document_id")
    return counts.join(t["directory_codes"].select("directory_id", "directory_label"), "directory_id").select(
        "directory_code", "directory_label", "doc_count")


@query("star_subjects", """SELECT v AS subject_name, count(*)::BIGINT AS doc_count FROM (
  SELECT unnest([o_orderpriority, o_orderstatus]) AS v FROM orders) GROUP BY 1
UNION ALL SELECT 'Descriptor ' || (o_orderkey % 11), count(*)::BIGINT FROM orders GROUP BY 1""")
def star_subjects(spark, sf):
    """Subjects and descriptors of the built schema, in one list."""
    t = S.star_schema(document_records(spark, sf), ("subject_matters", "document_subject_matters", "eurovoc_descriptors", "document_eurovoc_descriptors"))
    subjects = S.count_by_member(t["document_subject_matters"], t["subject_matters"], "subject_id", "subject_name", "document_id")
    words = S.count_by_member(t["document_eurovoc_descriptors"], t["eurovoc_descriptors"], "descriptor_id", "descriptor_name", "document_id")
    return subjects.select("subject_name", "doc_count").union(words.select("descriptor_name", "doc_count"))


@query("star_keys", """WITH r AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders)
SELECT 'documents' AS name, count(*)::BIGINT AS n_rows, count(*)::BIGINT AS last_id, count(*)::BIGINT AS n_ids FROM r
UNION ALL SELECT 'forms', count(DISTINCT o_orderstatus)::BIGINT, count(DISTINCT o_orderstatus)::BIGINT, count(DISTINCT o_orderstatus)::BIGINT FROM r
UNION ALL SELECT 'authors', n, n, n FROM (SELECT count(DISTINCT x)::BIGINT AS n FROM (SELECT unnest([o_custkey % 25, (o_custkey + 7) % 25,
  CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 25 ELSE (o_custkey + 3) % 25 END]) AS x FROM r))
UNION ALL SELECT 'subject_matters', n, n, n FROM (SELECT count(DISTINCT x)::BIGINT AS n FROM (SELECT unnest([o_orderpriority, o_orderstatus]) AS x FROM r))""")
def star_keys(spark, sf):
    """Every other record comes twice, changed; keys of all tables count from one without gaps."""
    records = document_records(spark, sf)
    again = records.filter(F.regexp_extract("content", "([0-9]+)$", 1).cast("long") % 2 == 0).withColumn("content", F.lit("changed"))
    t = S.star_schema(records.union(again), ("documents", "forms", "authors", "subject_matters"))
    out = None
    for name, key in (("documents", "document_id"), ("forms", "form_id"), ("authors", "author_id"), ("subject_matters", "subject_id")):
        row = t[name].agg(F.count(F.lit(1)).alias("n_rows"), F.max(key).alias("last_id"), F.countDistinct(key).alias("n_ids")).select(
            F.lit(name).alias("name"), "n_rows", "last_id", "n_ids")
        out = row if out is None else out.union(row)
    return out
