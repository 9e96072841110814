"""Text queries over documents: cleaning, sentences, leading extracts, word sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import measures as M
from docloom.functions import text as T
from docloom.operators import ngrams as N
from docloom.operators import star as S
from docloom.plans.lengths import WORDS_SQL
from docloom.plans.registry import query
from docloom.sources.tables import load, load_texts

def strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '^[{K.SPACE_CLASS}]+|[{K.SPACE_CLASS}]+$', '', 'g')"


WORD_LIST_SQL = f"regexp_extract_all(text, '{K.WORD_SPELLED}')"
STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in K.STOP_WORDS) + ")"


def docs(spark, sf):
    return load_texts(spark, sf, "documents", "doc_id", "text")


def clean_sql(expr: str) -> str:
    t = expr
    for pattern, replacement in (
        (K.URL_WITH_SCHEME, ""), (K.URL_WWW, ""), (K.CONTROL, ""), (r"[ \t]+", " "),
        (rf"\n[{K.SPACE_CLASS}]*\n", r"\n\n"), (rf"\n[{K.SPACE_CLASS}]+", r"\n"),
    ):
        rep = "chr(10) || chr(10)" if replacement == r"\n\n" else "chr(10)" if replacement == r"\n" else f"'{replacement}'"
        t = f"regexp_replace({t}, '{pattern}', {rep}, 'g')"
    return strip_sql(t)


CLEAN_SQL = f"""c AS (SELECT doc_id, {clean_sql("text")} AS t FROM documents),
cleaned AS (SELECT doc_id, CASE WHEN regexp_matches(t, '[a-zA-Z]{{2,}}') THEN t ELSE '' END AS t FROM c)"""


@query("clean_text", f"WITH {CLEAN_SQL} SELECT doc_id, t AS cleaned FROM cleaned")
def clean_text(spark, sf):
    return docs(spark, sf).select("doc_id", T.clean(F.col("text")).alias("cleaned"))


@query("valid_sections", """SELECT doc_id, len(l)::INT AS n_lines, len(list_filter(l, lambda x: regexp_matches(x, '[a-zA-Z]{2,}')))::INT AS n_valid
FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)""")
def valid_sections(spark, sf):
    """Lines stand in for candidate sections."""
    lines = F.split("text", "\n", -1)
    return docs(spark, sf).select("doc_id", F.size(lines).alias("n_lines"),
                                  F.size(F.filter(lines, T.is_meaningful)).alias("n_valid"))


@query("dedupe_lines", f"""WITH l AS (SELECT doc_id, i, {strip_sql('x')} AS x FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
f AS (SELECT doc_id, x, min(i) AS i FROM l WHERE x <> '' GROUP BY ALL)
SELECT d.doc_id, coalesce(string_agg(x, chr(10) ORDER BY i), '') AS lines FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id GROUP BY d.doc_id""")
def dedupe_lines(spark, sf):
    return docs(spark, sf).select("doc_id", T.distinct_lines(F.col("text")).alias("lines"))


@query("sentences", f"""WITH s AS (SELECT doc_id, unnest(list_filter(list_transform(regexp_extract_all(text, '{K.SENTENCE}'),
  lambda x: {strip_sql('x')}), lambda x: x <> '')) AS text FROM documents)
SELECT doc_id, text AS sentence, {WORDS_SQL} AS words, count(*)::BIGINT AS times FROM s GROUP BY ALL""")
def sentences(spark, sf):
    """Sentences per document with their word counts and how often each occurs there."""
    return docs(spark, sf).select("doc_id", F.explode(T.sentences(F.col("text"))).alias("sentence")).groupBy(
        "doc_id", "sentence").agg(F.count(F.lit(1)).alias("times")).select(
        "doc_id", "sentence", T.word_count(F.col("sentence")).alias("words"), "times")


@query("lead_extract", f"SELECT doc_id, array_to_string(({WORD_LIST_SQL})[1:300], ' ') AS extract FROM documents")
def lead_extract(spark, sf):
    return docs(spark, sf).select("doc_id", T.lead_words(F.col("text"), 300).alias("extract"))


@query("lead_summary", f"""WITH w AS (SELECT doc_id, {WORD_LIST_SQL} AS w, {WORDS_SQL} AS n FROM documents),
k AS (SELECT *, greatest(300, least(floor(CAST(0.3 AS DOUBLE) * n), 600)) AS k FROM w),
r AS (SELECT *, (CASE WHEN n <= 150 THEN 15 WHEN n <= 300 THEN 50 WHEN n <= 600 THEN 100 WHEN n <= 2500 THEN floor(CAST(0.6 AS DOUBLE) * k)
   WHEN n <= 20000 THEN 480 ELSE 600 END)::BIGINT AS lo,
  (CASE WHEN n <= 150 THEN 50 WHEN n <= 300 THEN 100 WHEN n <= 600 THEN 200 WHEN n <= 2500 THEN floor(CAST(0.8 AS DOUBLE) * k)
   WHEN n <= 20000 THEN 600 ELSE 800 END)::BIGINT AS hi FROM k)
SELECT doc_id, '[BART summary (' || lo || '-' || hi || ' words)]: ' || array_to_string(w[1:lo], ' ') || '...' AS summary FROM r""")
def lead_summary(spark, sf):
    n = F.col("n")
    return docs(spark, sf).withColumn("n", T.word_count(F.col("text"))).select(
        "doc_id", T.lead_summary(F.col("text"), M.summary_low(n), M.summary_high(n), "BART").alias("summary"))


@query("metadata_strings", """SELECT p_partkey, p_brand AS first_part, regexp_extract(p_name, '([^ ]+)$', 1) AS last_token,
  array_to_string(list_transform(string_split(p_name || ' , ' || p_type || ',' || p_brand, ','), lambda x: trim(x)), ' / ') AS joined FROM part""")
def metadata_strings(spark, sf):
    p = load(spark, sf, "part")
    raw = F.concat_ws(",", F.concat(F.col("p_name"), F.lit(" ")), F.concat(F.lit(" "), F.col("p_type")), F.col("p_brand"))
    return p.select(
        "p_partkey",
        T.before_semicolon(F.concat(F.col("p_brand"), F.lit("; remark"))).alias("first_part"),
        T.last_token(F.col("p_name")).alias("last_token"),
        F.array_join(T.comma_list(raw), " / ").alias("joined"))


@query("vector_norms", "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm FROM embeddings")
def vector_norms(spark, sf):
    return load(spark, sf, "embeddings").select("vec_id", F.round(M.l2_norm(F.col("embedding")), 6).alias("norm"))


@query("top_unigrams", f"""SELECT token, count(*)::BIGINT AS n FROM (
  SELECT unnest(regexp_extract_all(lower(text), '{K.WORD_TOKEN}')) AS token FROM documents)
WHERE regexp_matches(token, '{K.LETTERS_ONLY}') AND token NOT IN {STOP_SQL} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def top_unigrams(spark, sf):
    return S.top(N.unigram_counts(docs(spark, sf)), 20, "n", "token")


def _gram_sql(n):
    gram = " || ' ' || ".join(f"t[i{f' + {k}' if k else ''}]" for k in range(n))
    return f"""WITH t AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{K.GRAM_TOKEN}'), lambda x: x NOT IN {STOP_SQL}) AS t FROM documents),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(t) - {n - 2}), lambda i: {gram})) AS ngram FROM t WHERE len(t) >= {n})
SELECT ngram, count(*)::BIGINT AS n, count(DISTINCT doc_id)::BIGINT AS n_docs FROM g GROUP BY 1
HAVING count(DISTINCT doc_id) >= 2 ORDER BY 2 DESC, 1 LIMIT 20"""


@query("top_bigrams", _gram_sql(2))
def top_bigrams(spark, sf):
    return N.top_ngrams(docs(spark, sf), 2, 20)


@query("top_trigrams", _gram_sql(3))
def top_trigrams(spark, sf):
    return N.top_ngrams(docs(spark, sf), 3, 20)
