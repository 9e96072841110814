"""Section queries: conversation turns are the sections of a document."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators import dedup as D
from docloom.operators import legal_sections as G
from docloom.operators import lengths as L
from docloom.operators import pages as P
from docloom.operators import sections as X
from docloom.operators import star as S
from docloom.plans.lengths import WORDS_SQL
from docloom.plans.pages import PAGE_SECTIONS_SQL, raw_pages
from docloom.plans.registry import query
from docloom.plans.text import clean_sql, strip_sql
from docloom.session import shared_dir
from docloom.sources.tables import load, load_texts


def turns(spark, sf):
    return load_texts(spark, sf, "conversations", "conv_id", "turn", "role", "text")


@query("assembled_text", "SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def assembled_text(spark, sf):
    return X.assemble(load(spark, sf, "conversations"), "conv_id", "turn", "text")


@query("total_words", f"""WITH s AS (SELECT conv_id, sum({WORDS_SQL})::BIGINT AS total_words FROM conversations GROUP BY 1)
SELECT conv_id, total_words FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN s USING (conv_id)""")
def total_words(spark, sf):
    t = turns(spark, sf)
    docs = load(spark, sf, "conversations").select("conv_id").distinct()
    sections = X.backfill_word_counts(t, "text")
    return X.total_words(docs, sections, "conv_id")


@query("section_type_counts", "SELECT conv_id, role AS section_type, count(*)::BIGINT AS n_sections FROM conversations GROUP BY ALL")
def section_type_counts(spark, sf):
    return X.type_counts(load(spark, sf, "conversations").withColumnRenamed("role", "section_type"), "conv_id", "section_type")


@query("section_ordinals", """SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ordinal
FROM conversations""")
def section_ordinals(spark, sf):
    rows = load(spark, sf, "conversations").select("conv_id", "turn")
    return S.with_ordinal(rows, "conv_id", "turn").select("conv_id", "turn", "ordinal")


@query("backfill_word_counts", f"""SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN length(text) ELSE {WORDS_SQL} END::BIGINT AS word_count,
  sum(CASE WHEN turn % 2 = 0 THEN length(text) ELSE {WORDS_SQL} END) OVER (PARTITION BY conv_id)::BIGINT AS total_words FROM conversations""")
def backfill_word_counts(spark, sf):
    """Even turns bring a (deliberately odd) stored count, which must be kept."""
    t = turns(spark, sf).withColumn("word_count", F.when(F.col("turn") % 2 == 0, F.length("text")).cast("long"))
    filled = X.backfill_word_counts(t, "text").select("conv_id", "turn", "word_count")
    return X.total_words(filled, filled, "conv_id")


@query("nested_sections_json", """SELECT conv_id, count(*)::INT AS n_sections, string_agg(role, ',' ORDER BY turn) AS types,
  sum(length(text))::BIGINT AS n_chars FROM conversations GROUP BY conv_id""")
def nested_sections_json(spark, sf):
    """Documents with nested sections written as JSON, read back and measured."""
    path = shared_dir(spark, "nested")
    rows = load(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat(F.lit("Turn "), F.col("turn").cast("string")).alias("title"),
        F.col("text").alias("content"), F.col("role").alias("section_type"))
    X.nested(rows, "conv_id", "turn").write.json(path)
    back = spark.read.schema("conv_id long, sections array<struct<title:string,content:string,type:string>>").json(path)
    return back.select(
        "conv_id", F.size("sections").alias("n_sections"), F.array_join("sections.type", ",").alias("types"),
        F.aggregate("sections.content", F.lit(0).cast("long"), lambda a, c: a + F.length(c)).alias("n_chars"))


# --- class-marked pages ------------------------------------------------------------------------


def _escape(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def legal_pages(spark, sf):
    """One page per conversation: title, preamble, and an article with text, tables and a list per turn.

    Even turns leave out closing tags and close two elements in the wrong order; odd ones are well formed.
    """
    n = (F.col("turn") + 1).cast("string")
    role = F.col("role")
    cat = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])

    def article(loose):
        end = lambda *tags: "" if loose else "".join(f"</{t}>" for t in tags)
        return cat(
            '<div class="eli-subdivision" id="art"><p class="oj-ti-art">Article ', n, end("p"), '<p class="oj-normal">', _escape(F.col("text")), end("p"),
            '<table><col width="4%"/><col width="96%"><tbody><tr><td><p class="oj-normal">(', n, ")", end("p", "td"), "<td><p>said by ", role,
            '<a class="oj-note-tag"> (1)</a>', end("p", "td", "tr", "tbody"), "</table>",
            "<table><tr><td>", role, end("td"), "<td>123", end("td", "tr"), "<tr><td>alone", end("td", "tr"), "</table>",
            "<ul><li>point <b>of <i>", role, "</b></i>" if loose else "</i></b></li>", "<li>last point", end("li"), "</ul>",
            '<div class="oj-signatory"><p class="oj-normal">Signed', end("p"), "</div></div></section>" if loose else "</div></div>")

    article = F.when(F.col("turn") % 2 == 0, article(True)).otherwise(article(False))
    pages = load(spark, sf, "conversations").select("conv_id", "turn", article.alias("part"))
    body = X.assemble(pages, "conv_id", "turn", "part", "\n")
    key = F.col("conv_id").cast("string")
    html = cat(
        '<html><body><p class="oj-hd-lg">EN</p><div class="eli-container"><div class="eli-main-title"><p class="oj-doc-ti">Conversation</p> <p>number ',
        key, '</p></div><div class="eli-preamble"><p>Opening of ', key, "</p></div>", F.col("text"),
        '<p class="oj-normal">Closing words</p></div></body></html>')
    return body.select("conv_id", html.alias("html"))


LEGAL_SQL = f"""c AS (SELECT conv_id, turn, role, {clean_sql(strip_sql('text'))} AS s, {clean_sql('text')} AS w FROM conversations),
d AS (SELECT conv_id, turn, role, CASE WHEN regexp_matches(s, '[a-zA-Z]{{2,}}') THEN s END AS s, CASE WHEN regexp_matches(w, '[a-zA-Z]{{2,}}') THEN w END AS w,
  '(' || (turn + 1) || ') said by ' || role AS num FROM c),
a AS (SELECT conv_id, turn, 'Article ' || (turn + 1) AS title,
  concat_ws(chr(10), s, CASE WHEN s IS DISTINCT FROM num THEN num END, CASE WHEN s IS DISTINCT FROM role THEN role END,
    'point', 'of', 'last point') AS content FROM d),
m AS (SELECT conv_id, string_agg(concat_ws(chr(10), w, num, role), chr(10) ORDER BY turn) || chr(10) || 'Closing words' AS content FROM d GROUP BY conv_id)"""


@query("legal_sections", f"""WITH {LEGAL_SQL}
SELECT conv_id, 0 AS section_order, 'Document Title' AS title, 'Conversation number ' || conv_id AS content, 'header' AS section_type FROM m
UNION ALL SELECT conv_id, 1, 'Preamble', 'Opening of ' || conv_id, 'preamble' FROM m
UNION ALL SELECT conv_id, 2, 'Main Content', content, 'main' FROM m
UNION ALL SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) + 2)::INT, title, content, 'oj-ti-art' FROM a""")
def legal_sections(spark, sf):
    return G.sections(legal_pages(spark, sf), "conv_id", "html")


@query("build_processed_tables", f"""WITH {PAGE_SECTIONS_SQL}
SELECT page_id, sum({WORDS_SQL.replace('text', 'content')})::BIGINT AS total_words FROM sections
WHERE page_id NOT IN (SELECT doc_id FROM labels) GROUP BY page_id""")
def build_processed_tables(spark, sf):
    """Unprocessed pages to stored tables of documents and sections; the documents read back."""
    docs = raw_pages(spark, sf).filter(F.col("html").isNotNull())
    seen = load(spark, sf, "labels").select(F.col("doc_id").alias("page_id"))
    todo = D.unseen(docs, seen, "page_id")
    found = P.heading_sections(todo, "html", "page_id", "article").withColumn("section_type", F.lit("article"))
    path = shared_dir(spark, "processed")
    X.backfill_word_counts(found, "content").write.mode("overwrite").parquet(f"{path}/document_sections")
    sections = spark.read.parquet(f"{path}/document_sections")
    documents, _ = X.processed_tables(todo.select("page_id"), sections, "page_id")
    documents.write.mode("overwrite").parquet(f"{path}/processed_documents")
    return spark.read.parquet(f"{path}/processed_documents").select("page_id", "total_words")


@query("processed_tier_distribution", f"""WITH p AS (SELECT conv_id, sum({WORDS_SQL})::BIGINT AS words FROM conversations GROUP BY 1)
SELECT CASE WHEN words <= 600 THEN 'Tier 1 (0-600)' WHEN words <= 2500 THEN 'Tier 2 (601-2500)' WHEN words <= 20000 THEN 'Tier 3 (2501-20000)'
  ELSE 'Tier 4 (20000+)' END AS tier, count(*)::BIGINT AS n_docs, min(words)::BIGINT AS min_words FROM p GROUP BY 1""")
def processed_tier_distribution(spark, sf):
    sections = X.backfill_word_counts(turns(spark, sf), "text")
    docs = load(spark, sf, "conversations").select("conv_id").distinct()
    return L.tier_distribution(X.total_words(docs, sections, "conv_id").withColumnRenamed("total_words", "words"))
