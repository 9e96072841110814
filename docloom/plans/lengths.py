"""Length queries: form is the source of a document, body its language."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import measures as M
from docloom.operators import lengths as L
from docloom.operators import quantiles as Q
from docloom.plans.registry import query
from docloom.session import materialise
from docloom.sources.tables import load, load_texts

LONG_WORDS = 2500  # stands in for the outlier limit on a corpus whose longest text has 20,000 words

WORDS_SQL = f"coalesce(len(regexp_extract_all(text, '{K.WORD_SPELLED}')), 0)::BIGINT"
LENGTHS_SQL = f"""lengths AS (
  SELECT doc_id, source AS form, lang AS body, {WORDS_SQL} AS words,
         coalesce(length(text), 0)::BIGINT AS chars FROM documents)"""


def lengths(spark, sf):
    docs = load_texts(spark, sf, "documents", "doc_id", "text", "lang", "source")
    return L.with_lengths(docs).select(
        "doc_id", F.col("source").alias("form"), F.col("lang").alias("body"), "words", "chars")


@query("text_lengths", f"WITH {LENGTHS_SQL} SELECT doc_id, words, chars FROM lengths")
def text_lengths(spark, sf):
    return lengths(spark, sf).select("doc_id", "words", "chars")


TIER_SQL = """CASE WHEN words <= 600 THEN 'Tier 1 (0-600)' WHEN words <= 2500 THEN 'Tier 2 (601-2500)'
  WHEN words <= 20000 THEN 'Tier 3 (2501-20000)' ELSE 'Tier 4 (20000+)' END"""


@query("tier_distribution", f"""WITH {LENGTHS_SQL}
SELECT {TIER_SQL} AS tier, count(*)::BIGINT AS n_docs, min(words)::BIGINT AS min_words
FROM lengths GROUP BY 1 ORDER BY 3""")
def tier_distribution(spark, sf):
    return L.tier_distribution(lengths(spark, sf))


@query("document_tiers", f"""WITH {LENGTHS_SQL}
SELECT doc_id, CASE WHEN words <= 600 THEN 1 WHEN words <= 2500 THEN 2 WHEN words <= 20000 THEN 3 ELSE 4 END AS tier,
       words <= 68000 AS supported FROM lengths""")
def document_tiers(spark, sf):
    df = lengths(spark, sf)
    return df.select("doc_id", M.tier(F.col("words")).alias("tier"),
                     M.supported_tier(F.col("words")).isNotNull().alias("supported"))


@query("summary_targets", f"""WITH {LENGTHS_SQL}, k AS (
  SELECT doc_id, words, greatest(300, least(floor(CAST(0.3 AS DOUBLE) * words), 600))::BIGINT AS k FROM lengths)
SELECT doc_id, words, k AS extract_words,
 (CASE WHEN words <= 150 THEN 15 WHEN words <= 300 THEN 50 WHEN words <= 600 THEN 100
       WHEN words <= 2500 THEN floor(CAST(0.6 AS DOUBLE) * k) WHEN words <= 20000 THEN 480 ELSE 600 END)::BIGINT AS summary_min,
 (CASE WHEN words <= 150 THEN 50 WHEN words <= 300 THEN 100 WHEN words <= 600 THEN 200
       WHEN words <= 2500 THEN floor(CAST(0.8 AS DOUBLE) * k) WHEN words <= 20000 THEN 600 ELSE 800 END)::BIGINT AS summary_max
FROM k""")
def summary_targets(spark, sf):
    w = F.col("words")
    return lengths(spark, sf).select(
        "doc_id", "words", M.extraction_budget(w).alias("extract_words"),
        M.summary_low(w).alias("summary_min"), M.summary_high(w).alias("summary_max"))


@query("chunk_sizes", f"""WITH {LENGTHS_SQL}
SELECT doc_id, words, CASE WHEN words <= 100 THEN words
  ELSE greatest(100, least(words // greatest(1, words // 400), 400)) END::BIGINT AS chunk_size FROM lengths""")
def chunk_sizes(spark, sf):
    return lengths(spark, sf).select("doc_id", "words", M.balanced_chunk_size(F.col("words")).alias("chunk_size"))


@query("extraction_targets", f"""WITH n AS (
  SELECT conv_id, turn, {WORDS_SQL} AS words FROM conversations),
s AS (SELECT *, coalesce(([CAST(0.34 AS DOUBLE), 0.30, 0.245, 0.20, 0.165])[turn + 1], CAST(0.125 AS DOUBLE)) AS share FROM n)
SELECT conv_id, turn, words, share, CASE WHEN words <= 600 THEN words ELSE floor(words * share) END::BIGINT AS target_words
FROM s""")
def extraction_targets(spark, sf):
    """Turns stand in for the numbered chunks of a document."""
    from docloom.functions import text as T

    turns = load_texts(spark, sf, "conversations", "conv_id", "turn", "text")
    number = F.col("turn") + 1
    return turns.withColumn("words", T.word_count(F.col("text"))).select(
        "conv_id", "turn", "words", M.chunk_share(number).alias("share"),
        M.chunk_target(F.col("words"), number).alias("target_words"))


def _describe_sql(columns, source, group=None):
    g, out = (f"{group}, ", f"{group}, ") if group else ("", "")
    parts = [
        f"""SELECT {out}'{c}' AS measure, count({c})::BIGINT AS count, round(avg({c}), 6) AS mean,
 round(stddev_samp({c}), 6) AS std, min({c})::BIGINT AS min, round(quantile_cont({c}, 0.25), 6) AS p25,
 round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, max({c})::BIGINT AS max
FROM {source}""" + (f" GROUP BY {group}" if group else "")
        for c in columns
    ]
    return "\nUNION ALL\n".join(parts)


@query("length_describe", f"WITH {LENGTHS_SQL}\n" + _describe_sql(("words", "chars"), "lengths"))
def length_describe(spark, sf):
    return L.describe(lengths(spark, sf), ("words", "chars"))


@query("avg_words_by_form", f"WITH {LENGTHS_SQL} SELECT form, round(avg(words), 6) AS avg_words FROM lengths GROUP BY form")
def avg_words_by_form(spark, sf):
    return L.average_by(lengths(spark, sf))


def _profile_sql(where=""):
    def block(c, p):
        return f"""round(avg({c}), 6) AS {p}_mean, round(quantile_cont({c}, 0.5), 6) AS {p}_median,
 round(stddev_samp({c}), 6) AS {p}_std, min({c}) AS {p}_min, max({c}) AS {p}_max, count({c})::BIGINT AS {p}_count,
 round(quantile_cont({c}, 0.25), 6) AS {p}_25th, round(quantile_cont({c}, 0.75), 6) AS {p}_75th"""

    return f"""WITH {LENGTHS_SQL} SELECT form, {block('words', 'word')}, {block('chars', 'char')},
 round(quantile_cont(chars, 0.95), 6) AS char_95th FROM lengths {where} GROUP BY form"""


@query("length_profile_by_form", _profile_sql())
def length_profile_by_form(spark, sf):
    return L.profile(lengths(spark, sf))


# The seven forms that are kept for the filtered profile.
PROFILED_FORMS = ("src0", "src1", "src2", "src3", "src4", "src5", "src6")


@query("length_profile_filtered", _profile_sql(
    f"WHERE form IN {PROFILED_FORMS} AND words < {LONG_WORDS}"))
def length_profile_filtered(spark, sf):
    df = L.settle(lengths(spark, sf), "words")
    return L.profile(df.filter(F.col("form").isin(*PROFILED_FORMS) & (F.col("words") < LONG_WORDS)))


@query("length_percentiles", f"WITH {LENGTHS_SQL}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS measure, round(quantile_cont({c}, 0.9), 6) AS p90, round(quantile_cont({c}, 0.95), 6) AS p95 FROM lengths"
    for c in ("words", "chars")))
def length_percentiles(spark, sf):
    return L.corpus_percentiles(lengths(spark, sf), ("words", "chars"), (0.9, 0.95))


@query("length_percentiles_sketched", f"""WITH {LENGTHS_SQL}, f AS (SELECT form, count(*)::BIGINT AS n FROM lengths GROUP BY form)
SELECT form, p, n, true AS within FROM f, (VALUES (0.5::DOUBLE), (0.9), (0.95)) AS q(p)""")
def length_percentiles_sketched(spark, sf):
    """Word percentiles per form from sketches per form and language, held against their exact ranks."""
    rows = lengths(spark, sf).select("form", "body", "words")
    fine = materialise(Q.sketches(rows, ["form", "body"], "words"), "length-sketches")
    found = Q.approximate_percentiles(Q.merged(fine, ["form"]), ["form"], (0.5, 0.9, 0.95))
    errors = Q.rank_errors(found, Q.value_counts(rows, ["form"], "words"), ["form"], "words")
    return errors.select("form", "p", "n", (F.col("rank_error") <= Q.RANK_ERROR).alias("within"))


@query("form_percentiles", f"""WITH {LENGTHS_SQL}
SELECT count(*)::BIGINT AS n_docs, round(quantile_cont(words, 0.9), 6) AS words_p90, round(quantile_cont(chars, 0.9), 6) AS chars_p90,
       count(*) FILTER (WHERE words > {LONG_WORDS})::BIGINT AS n_long FROM lengths WHERE form = 'src3'""")
def form_percentiles(spark, sf):
    """One form: size, 90th percentiles and the number of long documents."""
    return L.form_report(lengths(spark, sf).filter(F.col("form") == "src3"), LONG_WORDS)


@query("long_docs_by_form", f"""WITH {LENGTHS_SQL}
SELECT form, count(*) FILTER (WHERE words > {LONG_WORDS})::BIGINT AS n_long, count(*)::BIGINT AS n_docs FROM lengths GROUP BY form""")
def long_docs_by_form(spark, sf):
    return L.long_documents(lengths(spark, sf), LONG_WORDS, "form")


@query("corpus_stats", f"""WITH {LENGTHS_SQL}
SELECT count(*)::BIGINT AS total_docs, round(avg(words), 6) AS avg_words, min(words) AS min_words, max(words) AS max_words FROM lengths""")
def corpus_stats(spark, sf):
    return L.corpus_stats(lengths(spark, sf))


@query("length_ranges", f"""WITH {LENGTHS_SQL}, r(range, lo, hi) AS (VALUES ('600-1000', 600, 1000), ('1001-1500', 1001, 1500),
  ('1501-2000', 1501, 2000), ('2001-2500', 2001, 2500)), picked AS (SELECT * FROM lengths WHERE words > 600 AND words <= 2500)
SELECT range, count(doc_id)::BIGINT AS n_docs, round(count(doc_id) * 100.0 / (SELECT count(*) FROM picked), 6)::DOUBLE AS percent
FROM r LEFT JOIN picked ON words BETWEEN lo AND hi GROUP BY range""")
def length_ranges(spark, sf):
    """Over the processed tier, as the run report shows it."""
    df = L.settle(lengths(spark, sf), "words")
    return L.report_ranges(df.filter((F.col("words") > 600) & (F.col("words") <= 2500)))


@query("length_histogram", f"""WITH {LENGTHS_SQL}, b AS (SELECT min(chars) AS lo, max(chars) AS hi FROM lengths),
f AS (SELECT least(floor((chars - lo) / ((hi - lo) / 50)) + 1, 50)::INT AS bin, count(*) AS n FROM lengths, b GROUP BY 1)
SELECT g.bin::INT AS bin, round(lo + (g.bin - 1) * ((hi - lo) / 50), 6) AS bin_start, round(lo + g.bin * ((hi - lo) / 50), 6) AS bin_end,
       coalesce(n, 0)::BIGINT AS n_docs FROM b, range(1, 51) g(bin) LEFT JOIN f ON f.bin = g.bin""")
def length_histogram(spark, sf):
    return L.histogram(lengths(spark, sf), "chars")


@query("word_histogram", f"""WITH {LENGTHS_SQL}, b AS (SELECT min(words) AS lo, max(words) AS hi FROM lengths),
f AS (SELECT least(floor((words - lo) / ((hi - lo) / 50)) + 1, 50)::INT AS bin, count(*) AS n FROM lengths, b GROUP BY 1)
SELECT g.bin::INT AS bin, round(lo + (g.bin - 1) * ((hi - lo) / 50), 6) AS bin_start, round(lo + g.bin * ((hi - lo) / 50), 6) AS bin_end,
       coalesce(n, 0)::BIGINT AS n_docs FROM b, range(1, 51) g(bin) LEFT JOIN f ON f.bin = g.bin""")
def word_histogram(spark, sf):
    return L.histogram(lengths(spark, sf), "words")


@query("boxplot_by_form", f"""WITH {LENGTHS_SQL}, q AS (
  SELECT form, quantile_cont(words, 0.25) AS q1, quantile_cont(words, 0.5) AS median, quantile_cont(words, 0.75) AS q3
  FROM lengths GROUP BY form),
j AS (SELECT l.form, q1, median, q3, words,
             words BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside FROM lengths l JOIN q USING (form))
SELECT form, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
  min(words) FILTER (WHERE inside) AS whisker_low, max(words) FILTER (WHERE inside) AS whisker_high,
  count(*) FILTER (WHERE NOT inside)::BIGINT AS n_outliers FROM j GROUP BY form""")
def boxplot_by_form(spark, sf):
    return L.boxplot(lengths(spark, sf))


DENSITY_SQL = f"""WITH {LENGTHS_SQL},
s AS (SELECT count(*) AS n_all, max(chars)::DOUBLE AS top, stddev_samp(chars) * pow(count(*)::DOUBLE, -0.2) AS h FROM lengths),
grid AS (SELECT i::INT AS grid_no, i * (top / 999.0::DOUBLE) AS x, n_all, h FROM s, range(0, 1000) r(i)),
c AS (SELECT chars, count(*) AS n FROM lengths GROUP BY chars),
density AS (SELECT grid_no, x, sum(n * exp(-0.5 * ((x - chars) / h) * ((x - chars) / h))) / (any_value(n_all) * any_value(h) * sqrt(2 * pi())) AS density
  FROM grid, c GROUP BY grid_no, x)"""


@query("length_kde", DENSITY_SQL + """
SELECT grid_no, round(x, 6) AS x, round(density * 1e6, 6) AS density_per_million FROM density""")
def length_kde(spark, sf):
    d = L.kernel_density(lengths(spark, sf))
    return d.select("grid_no", F.round("x", 6).alias("x"),
                    F.round(F.col("density") * 1e6, 6).alias("density_per_million"))


PEAKS_SQL = """
SELECT grid_no, floor(x)::BIGINT AS breakpoint FROM (
  SELECT *, lag(density) OVER (ORDER BY grid_no) AS l, lead(density) OVER (ORDER BY grid_no) AS r FROM density)
WHERE density > l AND density > r"""


@query("length_breakpoints", DENSITY_SQL + PEAKS_SQL)
def length_breakpoints(spark, sf):
    return L.density_peaks(L.kernel_density(lengths(spark, sf)))


@query("length_breakpoints_filtered", DENSITY_SQL.replace(
    "FROM documents)", f"FROM documents WHERE {WORDS_SQL} < {LONG_WORDS})") + PEAKS_SQL)
def length_breakpoints_filtered(spark, sf):
    df = L.settle(lengths(spark, sf), "words").filter(F.col("words") < LONG_WORDS)
    return L.density_peaks(L.kernel_density(df))


@query("outlier_split", f"""WITH {LENGTHS_SQL}
SELECT CASE WHEN words < {LONG_WORDS} THEN 'kept' ELSE 'excluded' END AS part, count(*)::BIGINT AS n_docs,
       round(avg(words), 6) AS avg_words, max(words) AS max_words FROM lengths GROUP BY 1""")
def outlier_split(spark, sf):
    part = F.when(F.col("words") < LONG_WORDS, "kept").otherwise("excluded")
    return lengths(spark, sf).groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.round(F.avg("words"), 6).alias("avg_words"),
        F.max("words").alias("max_words"))


@query("excluded_documents", f"WITH {LENGTHS_SQL} SELECT doc_id, words FROM lengths WHERE words >= {LONG_WORDS}")
def excluded_documents(spark, sf):
    return lengths(spark, sf).filter(F.col("words") >= LONG_WORDS).select("doc_id", "words")


_PAIR_SQL = """p AS (
  SELECT conv_id, turn, length(text) AS doc_length, lead(length(text)) OVER w AS summ_length,
         role, lead(role) OVER w AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pairs AS (SELECT doc_length::BIGINT AS doc_length, summ_length::BIGINT AS summ_length FROM p WHERE role = 'user' AND next_role = 'assistant')"""


@query("reference_pair_lengths", f"WITH {_PAIR_SQL}\n" + _describe_sql(("doc_length", "summ_length"), "pairs"))
def reference_pair_lengths(spark, sf):
    """Length statistics of (text, summary) pairs; a user turn and the answer after it are a pair.

    The answer is found by a join on (conversation, turn + 1) over lengths only: no text is
    shuffled, and a conversation with very many turns is spread over the cluster.
    """
    turns = load(spark, sf, "conversations").select("conv_id", "turn", "role", F.length("text").alias("len"))
    ask = turns.filter(F.col("role") == "user").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("len").alias("doc_length"))
    answer = turns.filter(F.col("role") == "assistant").select("conv_id", "turn", F.col("len").alias("summ_length"))
    return L.describe(ask.join(answer, ["conv_id", "turn"]), ("doc_length", "summ_length"))
