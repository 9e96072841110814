"""Page queries: the raw pages, and metadata and index pages rendered from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import constants as K
from docloom.operators import pages as P
from docloom.plans.registry import query
from docloom.plans.text import clean_sql, strip_sql
from docloom.sources.tables import load_texts

BASE_URL = "https://example.org"


def raw_pages(spark, sf):
    return load_texts(spark, sf, "pages", "page_id", "html")


def decode_sql(e):
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        e = f"replace({e}, '{name}', '{char}')"
    return e


# Tokens of the article, block boundaries counted; the text pieces of a block are put together.
ARTICLE_SQL = f"""a AS (SELECT page_id, regexp_extract(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g'),
  '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1) AS art FROM pages),
k AS (SELECT page_id, unnest(regexp_extract_all(art, '<[^>]+>|[^<]+')) AS tok, generate_subscripts(regexp_extract_all(art, '<[^>]+>|[^<]+'), 1) AS pos FROM a),
n AS (SELECT *, sum((regexp_matches(tok, '(?i)^</?({P.BLOCK_TAGS})\\b'))::INT) OVER (PARTITION BY page_id ORDER BY pos) AS block FROM k),
b AS (SELECT page_id, block, string_agg({strip_sql(decode_sql('tok'))}, '' ORDER BY pos) AS line FROM n WHERE NOT starts_with(tok, '<') GROUP BY ALL)"""


@query("page_text", f"""WITH {ARTICLE_SQL} SELECT page_id, coalesce(string_agg(line, chr(10) ORDER BY block) FILTER (WHERE line <> ''), '') AS full_text
FROM pages LEFT JOIN b USING (page_id) GROUP BY page_id""")
def page_text(spark, sf):
    """The article element is the text container of these pages."""
    region = P.element(F.col("_clean"), r"(?i)<article\b[^>]*>", "article")
    return P.page_text(raw_pages(spark, sf), "html", region).select("page_id", "full_text")


PAGE_SECTIONS_SQL = f"""{ARTICLE_SQL},
h AS (SELECT page_id, min(pos) FILTER (WHERE regexp_matches(tok, '(?i)^<h1\\b')) AS h0, min(pos) FILTER (WHERE regexp_matches(tok, '(?i)^</h1')) AS h1 FROM k GROUP BY page_id),
t AS (SELECT page_id, {clean_sql(strip_sql(decode_sql("string_agg(tok, '' ORDER BY pos)")))} AS title
  FROM k JOIN h USING (page_id) WHERE pos > h0 AND pos < h1 AND NOT starts_with(tok, '<') GROUP BY page_id),
c AS (SELECT n.page_id, block, string_agg({strip_sql(decode_sql('tok'))}, '' ORDER BY pos) AS line FROM n JOIN h ON h.page_id = n.page_id
  WHERE pos > h1 AND NOT starts_with(tok, '<') GROUP BY ALL),
j AS (SELECT page_id, string_agg(line, chr(10) ORDER BY block) AS content FROM c WHERE line <> '' GROUP BY page_id),
sections AS (SELECT page_id, 0 AS section_order, title, coalesce(content, '') AS content FROM t LEFT JOIN j USING (page_id)
  WHERE regexp_matches(title, '[a-zA-Z]{{2,}}'))"""


@query("page_sections", f"WITH {PAGE_SECTIONS_SQL} SELECT * FROM sections")
def page_sections(spark, sf):
    """Sections of pages marked up with heading tags."""
    return P.heading_sections(raw_pages(spark, sf), "html", "page_id", "article")


@query("page_links", """WITH l AS (SELECT page_id, unnest(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="([^"]*)">([^<]*)</a>', 1)) AS href,
  unnest(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="([^"]*)">([^<]*)</a>', 2)) AS label FROM pages),
x AS (SELECT page_id, (row_number() OVER (PARTITION BY page_id))::INT AS link_no, href, label, count(*) OVER (PARTITION BY page_id) AS n FROM l)
SELECT page_id, link_no, 'https://example.org/legal-content/EN/TXT/?uri=OJ:L_2024' || lpad((page_id * 10 + link_no)::VARCHAR, 5, '0') || '&from=EN' AS url,
  'Doc ' || link_no || CASE WHEN link_no % 4 = 1 THEN '' WHEN link_no = n THEN ' and  end' ELSE ' and other end' END AS title, '2024' || lpad((page_id * 10 + link_no)::VARCHAR, 5, '0') AS document_id
FROM x WHERE link_no % 2 = 1 AND lpad((page_id * 10 + link_no)::VARCHAR, 5, '0')[1] <> '9'""")
def page_links(spark, sf):
    """Index pages rendered from the navigation of every page.

    Odd entries become document links, even ones keep their foreign address. Every second document link has no text and shares its list
    item with the entry behind it, so its title is the text of the whole item.
    """
    nav = F.regexp_extract_all(F.regexp_extract("html", "(?s)<nav>(.*?)</nav>", 1), F.lit('<a href="([^"]*)">'), F.lit(1))

    def item(href, i):
        no = F.lpad((F.col("page_id") * 10 + i + 1).cast("string"), 5, "0")
        label = F.concat(F.lit("Doc "), (i + 1).cast("string"))
        doc = F.concat(F.lit('<a class="x" href="/legal-content/EN/TXT/?uri=OJ:L_2024'), no, F.lit('&amp;from=EN">'))
        other = lambda h: F.concat(F.lit('<a href="'), h, F.lit('">other</a>'))
        shared = F.concat(label, doc, F.lit("</a> and "), F.coalesce(other(F.get(nav, i + 1)), F.lit("")), F.lit(" end"))
        text = F.when(i % 4 == 0, F.concat(doc, label, F.lit("</a>"))).when(i % 4 == 1, other(href)).when(i % 4 == 2, shared)
        return F.when(i % 4 == 3, F.lit("")).otherwise(F.concat(F.lit("<li>"), text, F.lit("</li>")))

    body = F.concat(
        F.lit('<html><body><a href="/legal-content/EN/TXT/?uri=OJ:L_202400001">outside</a><div id="MainContent"><div class="inner"><ul>'),
        F.array_join(F.transform(nav, item), ""), F.lit("</ul></div></div></body></html>"))
    index = raw_pages(spark, sf).select("page_id", body.alias("html"))
    return P.links(index, "html", "page_id", BASE_URL)


def metadata_pages(spark, sf, *others):
    """A metadata page per order, in the layout of the document pages."""
    k = F.col("o_orderkey").cast("string")
    day = lambda p: F.date_format("o_orderdate", p)
    cat = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    eli = F.when(F.col("o_orderkey") % 19 == 0, F.lit("")).otherwise(
        cat('<p>See <a class="l" href="http://data.europa.eu/eli/dec/', day("yyyy"), "/", k, '">ELI</a></p>'))
    ident = F.when(F.col("o_orderkey") % 5 == 0, F.lit("")).otherwise(cat("<p>A/", day("yyyy"), "/", k, "</p>"))
    body = F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(
        cat("<dt>Responsible body: </dt><dd>Body ", F.col("o_orderpriority"), "</dd>"))
    html = cat(
        '<html><head><script>var d = "<dt>Form</dt><dd>wrong</dd>";</script></head><body>',
        '<p class="DocumentTitle pull-left">Document 3', day("yyyy"), "R", k, "</p>",
        '<div><p id="title" lang="en">Order &amp; text ', k, '</p><p id="originalTitle" class="hidden">Original</p>', ident, "</div>", eli,
        '<dl class="NMetadata"><dt>Date of document: </dt><dd>', day("dd/MM/yyyy"), "; adoption</dd>",
        "<dt>Date of effect: </dt><dd>", day("dd.MM.yyyy"), "; entry into force</dd>",
        "<dt>Date of end of validity: </dt><dd>No end date</dd></dl>",
        '<dl class="NMetadata"><dt>EUROVOC descriptor: </dt><dd><ul><li><a><span>', F.col("o_orderpriority"), "</span></a></li><li><a>",
        F.col("o_orderstatus"), "</a></li></ul></dd>",
        "<dt>Subject matter: </dt><dd><ul><li><a>Subject ", F.col("o_orderstatus"), "</a></li></ul></dd>",
        "<dt>Directory code: </dt><dd><ul><li>11.40.", k, " <a><span>External </span></a><a><span>Status ", F.col("o_orderstatus"), "</span></a></li></ul></dd></dl>",
        '<dl class="NMetadata"><dt>Author: </dt><dd>Council, Customer ', F.col("o_custkey").cast("string"), "</dd>", body,
        "<dt>Form: </dt><dd>Form ", F.col("o_orderstatus"), "</dd></dl></body></html>")
    return load_texts(spark, sf, "orders").select("o_orderkey", *others, html.alias("html"))


@query("page_metadata", """SELECT o_orderkey, '3' || strftime(o_orderdate, '%Y') || 'R' || o_orderkey AS celex_number, 'Order & text ' || o_orderkey AS title,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'A/' || strftime(o_orderdate, '%Y') || '/' || o_orderkey ELSE 'Order & text ' || o_orderkey END AS identifier,
  CASE WHEN o_orderkey % 19 <> 0 THEN 'http://data.europa.eu/eli/dec/' || strftime(o_orderdate, '%Y') || '/' || o_orderkey END AS eli_uri,
  strftime(o_orderdate, '%d/%m/%Y') AS date_of_document, strftime(o_orderdate, '%d.%m.%Y') AS date_of_effect, 'No end date' AS date_of_end,
  'Council|Customer ' || o_custkey AS authors, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'Body ' || o_orderpriority END AS responsible_body,
  'Form ' || o_orderstatus AS form, o_orderpriority || '|' || o_orderstatus AS eurovoc, 'Subject ' || o_orderstatus AS subjects,
  '11.40.' || o_orderkey AS directory_codes, 'External / Status ' || o_orderstatus AS directory_descriptions,
  CASE WHEN o_orderkey % 19 = 0 THEN 'incomplete' ELSE 'ok' END AS status FROM orders""")
def page_metadata(spark, sf):
    m = P.page_metadata(metadata_pages(spark, sf), "html")
    return m.select(
        "o_orderkey", "celex_number", "title", "identifier", "eli_uri",
        F.col("dates")[K.DATE_LABELS[0]].alias("date_of_document"), F.col("dates")[K.DATE_LABELS[1]].alias("date_of_effect"),
        F.col("dates")[K.DATE_LABELS[2]].alias("date_of_end"), F.array_join("authors", "|").alias("authors"),
        "responsible_body", "form", F.array_join("eurovoc_descriptors", "|").alias("eurovoc"),
        F.array_join("subject_matters", "|").alias("subjects"), F.array_join("directory_codes", "|").alias("directory_codes"),
        F.array_join("directory_descriptions", "|").alias("directory_descriptions"), "status")
