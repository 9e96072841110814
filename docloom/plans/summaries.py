"""Chunking, selection and tiered summary queries over documents."""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import measures as M
from docloom.functions import text as T
from docloom.functions.arrays import hold
from docloom.operators import chunking as C
from docloom.operators import extraction as E
from docloom.operators import lengths as L
from docloom.operators import summary as U
from docloom.plans.lengths import LENGTHS_SQL, WORDS_SQL
from docloom.plans.registry import query
from docloom.plans.text import docs, strip_sql
from docloom.session import materialise
from docloom.sources.tables import load


def count_sql(expr):
    return f"coalesce(len(regexp_extract_all({expr}, '{K.WORD_SPELLED}')), 0)::BIGINT"


def sentence_list_sql(expr):
    return (f"list_filter(list_transform(regexp_extract_all({expr}, '{K.SENTENCE}'), "
            f"lambda s: {strip_sql('s')}), lambda s: s <> '')")


# Packing as a fold: out collects the chunk number of every sentence.
CHUNKS_SQL = f"""sl AS (SELECT doc_id, {sentence_list_sql('text')} AS s FROM documents),
fo AS (SELECT doc_id, s, list_reduce(list_transform(s, lambda x: {{n: {count_sql('x')}, cur: {count_sql('x')}, c: 1, out: [1]}}),
  lambda a, x: {{n: x.n, cur: CASE WHEN a.cur + x.n <= 1000 THEN a.cur + x.n ELSE x.n END,
    c: CASE WHEN a.cur + x.n <= 1000 THEN a.c ELSE a.c + 1 END,
    out: list_append(a.out, CASE WHEN a.cur + x.n <= 1000 THEN a.c ELSE a.c + 1 END)}}).out AS out FROM sl WHERE len(s) > 0),
se AS (SELECT doc_id, unnest(s) AS s, unnest(out) AS chunk_no, generate_subscripts(s, 1) AS i FROM fo),
ch AS (SELECT doc_id, chunk_no, string_agg(s, ' ' ORDER BY i) AS chunk FROM se GROUP BY ALL)"""


@query("sentence_chunks", f"WITH {CHUNKS_SQL} SELECT doc_id, chunk_no, chunk, {count_sql('chunk')} AS words FROM ch")
def sentence_chunks(spark, sf):
    df = hold(docs(spark, sf), chunks=C.sentence_chunks(F.col("text")))
    return df.select("doc_id", F.posexplode("chunks").alias("pos", "chunk")).select(
        "doc_id", (F.col("pos") + 1).alias("chunk_no"), "chunk", T.word_count(F.col("chunk")).alias("words"))


# The cascade, level by level: a path of places orders the pieces, those that fit pass through.
def _level_sql(prev: str, name: str, pieces: str, count) -> str:
    return f"""{name} AS (SELECT * FROM {prev} WHERE n <= {K.MAX_TOKENS} UNION ALL SELECT doc_id, list_append(path, i), p, {count('p')} FROM (
  SELECT doc_id, path, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM (SELECT doc_id, path, {pieces} AS ps FROM {prev} WHERE n > {K.MAX_TOKENS})))"""


def _stripped_sql(pieces: str) -> str:
    return f"list_filter(list_transform({pieces}, lambda p: {strip_sql('p')}), lambda p: p <> '')"


def _header_sql(pattern: str) -> str:
    return _stripped_sql(f"string_split(regexp_replace(piece, '({pattern})', chr(57344) || '\\1', 'g'), chr(57344))")


def _numbered_sql(items: str, fresh: str) -> str:
    """Numbers of the chunks that items (n, and whether one begins anew) are packed to."""
    begins = f"{fresh} OR a.cur + x.n > {K.MAX_TOKENS}"
    return f"""list_reduce(list_transform({items}, lambda x: {{n: x.n, fresh: x.fresh, cur: x.n, c: 1, out: [1]}}), lambda a, x: {{n: x.n, fresh: x.fresh,
  cur: CASE WHEN {begins} THEN x.n ELSE a.cur + x.n END, c: CASE WHEN {begins} THEN a.c + 1 ELSE a.c END,
  out: list_append(a.out, CASE WHEN {begins} THEN a.c + 1 ELSE a.c END)}}).out"""


def structure_sql(count=count_sql) -> str:
    """Chunks ``st`` (doc_id, chunk_no, chunk) of all documents, by any counter."""
    return f"""h0 AS (SELECT doc_id, [0] AS path, text AS piece, {count('text')} AS n FROM documents WHERE length(text) > 0),
{_level_sql('h0', 'h1', _header_sql(K.HEADER_PATTERNS[0]), count)},
{_level_sql('h1', 'h2', _header_sql(K.HEADER_PATTERNS[1]), count)},
{_level_sql('h2', 'h3', _header_sql(K.HEADER_PATTERNS[2]), count)},
pa AS (SELECT doc_id, path, {_stripped_sql(f"string_split_regex(piece, '{K.BLANK_LINE}')")} AS ps FROM h3 WHERE n > {K.MAX_TOKENS}),
pb AS (SELECT doc_id, path, ps, {_numbered_sql(f"list_transform(ps, lambda p: {{n: {count('p')}, fresh: false}})", 'x.fresh')} AS out FROM pa WHERE len(ps) > 0),
pc AS (SELECT doc_id, path, unnest(ps) AS p, unnest(out) AS c, generate_subscripts(ps, 1) AS i FROM pb),
pd AS (SELECT doc_id, list_append(path, c) AS path, string_agg(p, chr(10) || chr(10) ORDER BY i) AS piece FROM pc GROUP BY doc_id, path, c),
h4 AS (SELECT * FROM h3 WHERE n <= {K.MAX_TOKENS} UNION ALL SELECT doc_id, path, piece, {count('piece')} FROM pd),
sa AS (SELECT doc_id, path, unnest(s) AS s, generate_subscripts(s, 1) AS i FROM (SELECT doc_id, path, {sentence_list_sql('piece')} AS s FROM h4 WHERE n > {K.MAX_TOKENS})),
sb AS (SELECT *, regexp_extract_all(s, '{K.WORD_SPELLED}') AS w, {count('s')} AS n FROM sa),
sw AS (SELECT doc_id, path, i, generate_subscripts(w, 1) AS j, unnest(w) AS t FROM sb WHERE n > {K.MAX_TOKENS}),
sc AS (SELECT doc_id, path, i, 0 AS j, s AS t, n, false AS fresh FROM sb WHERE n <= {K.MAX_TOKENS}
  UNION ALL SELECT doc_id, path, i, j, t, {count('t')}, j = 1 FROM sw),
sd AS (SELECT doc_id, path, list(t ORDER BY i, j) AS t, list({{n: n, fresh: fresh}} ORDER BY i, j) AS it FROM sc GROUP BY doc_id, path),
sf AS (SELECT doc_id, path, unnest(t) AS t, unnest({_numbered_sql('it', 'x.fresh')}) AS c, generate_subscripts(t, 1) AS i FROM sd),
h5 AS (SELECT doc_id, path, piece FROM h4 WHERE n <= {K.MAX_TOKENS}
  UNION ALL SELECT doc_id, list_append(path, c), string_agg(t, ' ' ORDER BY i) FROM sf GROUP BY doc_id, path, c),
st AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY path))::INT AS chunk_no, piece AS chunk FROM h5)"""


STRUCTURE_SQL = structure_sql()


@query("structure_chunks", f"WITH {STRUCTURE_SQL} SELECT doc_id, chunk_no, chunk, {count_sql('chunk')} AS words FROM st")
def structure_chunks(spark, sf):
    df = hold(docs(spark, sf), chunks=C.structure_chunks(F.col("text")))
    return df.select("doc_id", F.posexplode("chunks").alias("pos", "chunk")).select(
        "doc_id", (F.col("pos") + 1).alias("chunk_no"), "chunk", T.word_count(F.col("chunk")).alias("words"))


TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


def token_count_sql(expr: str) -> str:
    return f"coalesce(len(regexp_extract_all({expr}, '{TOKEN}')), 0)::BIGINT"


def count_tokens(texts: pd.Series) -> pd.Series:
    """Words and single marks, as a simple tokenizer cuts them."""
    return texts.map(lambda t: len(regex.findall(TOKEN, t)))


@query("structure_chunks_tokens", f"WITH {structure_sql(token_count_sql)} SELECT doc_id, chunk_no, chunk, {token_count_sql('chunk')} AS tokens FROM st")
def structure_chunks_tokens(spark, sf):
    """Structure chunks by a token counter in Python."""
    df = C.structure_chunks_by(docs(spark, sf), "text", "chunks", C.count_by_batches(count_tokens))
    df = df.select("doc_id", F.posexplode("chunks").alias("pos", "chunk"))
    return df.select("doc_id", (F.col("pos") + 1).alias("chunk_no"), "chunk", F.regexp_count("chunk", F.lit(TOKEN)).cast("long").alias("tokens"))


@query("sentence_scores", f"""WITH s AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos FROM (
  SELECT doc_id, {sentence_list_sql('text')} AS s FROM documents)),
t AS (SELECT doc_id, pos, token, count(*) AS tf FROM (SELECT doc_id, pos, unnest(regexp_extract_all(lower(sentence), '{K.WORD_TOKEN}')) AS token FROM s) GROUP BY ALL),
d AS (SELECT token, count(DISTINCT doc_id) AS df FROM t GROUP BY token),
w AS (SELECT doc_id, pos, sqrt(sum(pow(tf * (ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1), 2))) AS score FROM t JOIN d USING (token) GROUP BY ALL)
SELECT doc_id, pos::INT AS pos, sentence, round(coalesce(score, 0), 6) AS score FROM s LEFT JOIN w USING (doc_id, pos)""")
def sentence_scores(spark, sf):
    return E.tfidf_scores(docs(spark, sf), "doc_id").withColumn("score", F.round("score", 6))


#: What a sentence scores: by its term counts, by those weighted over the corpus (table idf: token, idf), by its length.
SCORES_SQL = {"terms": ("sum(c * c)::DOUBLE", "", "coalesce(sqrt(q), 0)"),
              "tfidf": ("sum(pow(c * idf, 2))", "JOIN idf ON idf.token = t", "round(coalesce(sqrt(q), 0), 9)"),
              "length": ("sum(c * c)::DOUBLE", "", "length(s)::DOUBLE")}


def selection_sql(source: str, lower: str, upper: str, keys: str, p: str = "x", score: str = "terms") -> str:
    """Rows (keys, chunk, lower, upper) to rows (keys, extract), by the selection rule as a fold."""
    total, weights, value = SCORES_SQL[score]
    return f"""{p}b AS (SELECT {keys}, chunk, ({lower})::BIGINT AS lo, ({upper})::BIGINT AS hi FROM {source}),
{p}s AS (SELECT {keys}, lo, hi, unnest({sentence_list_sql('chunk')}) AS s, generate_subscripts({sentence_list_sql('chunk')}, 1) AS i FROM {p}b),
{p}t AS (SELECT {keys}, i, {total} AS q FROM (SELECT {keys}, i, t, count(*) AS c FROM (
  SELECT {keys}, i, unnest(regexp_extract_all(lower(s), '{K.WORD_TOKEN}')) AS t FROM {p}s) GROUP BY ALL) {weights} GROUP BY {keys}, i),
{p}q AS (SELECT {p}s.*, {count_sql('s')} AS n, {value} AS score FROM {p}s LEFT JOIN {p}t USING ({keys}, i)),
{p}f AS (SELECT *, first_value(score) OVER (PARTITION BY {keys} ORDER BY i) AS f FROM {p}q),
{p}l AS (SELECT {keys}, list({{n: n, i: i, score: score, f: f, lo: lo, hi: hi, words: n, kept: [i], done: false}} ORDER BY score DESC, i) AS l FROM {p}f GROUP BY {keys}),
{p}r AS (SELECT {keys}, unnest(list_reduce(l, lambda a, x: {{n: x.n, i: x.i, score: x.score, f: x.f, lo: x.lo, hi: x.hi,
  words: CASE WHEN a.done OR (a.words >= x.lo AND (x.score < x.f * 0.5::DOUBLE OR a.words >= x.hi)) OR a.words + x.n > x.hi * 1.1::DOUBLE THEN a.words ELSE a.words + x.n END,
  kept: CASE WHEN a.done OR (a.words >= x.lo AND (x.score < x.f * 0.5::DOUBLE OR a.words >= x.hi)) OR a.words + x.n > x.hi * 1.1::DOUBLE THEN a.kept ELSE list_append(a.kept, x.i) END,
  done: a.done OR (a.words >= x.lo AND (x.score < x.f * 0.5::DOUBLE OR a.words >= x.hi))}}).kept) AS i FROM {p}l),
{p}e AS (SELECT {keys}, string_agg(s, ' ' ORDER BY i) AS extract FROM {p}r JOIN {p}s USING ({keys}, i) GROUP BY {keys})"""


SHARE_SQL = "coalesce(([0.34::DOUBLE, 0.30, 0.245, 0.20, 0.165])[chunk_no], 0.125::DOUBLE)"

TARGET_SQL = f"CASE WHEN {count_sql('chunk')} <= 600 THEN {count_sql('chunk')}::DOUBLE ELSE floor({count_sql('chunk')} * {SHARE_SQL}) END"
VARIANCE_SQL = "CASE WHEN chunk_no <= 2 THEN 0.25::DOUBLE ELSE 0.2::DOUBLE END"
CHUNK_BOUNDS = (f"floor(({TARGET_SQL}) * (1.0::DOUBLE - {VARIANCE_SQL}))", f"floor(({TARGET_SQL}) * (1.0::DOUBLE + {VARIANCE_SQL}))")


@query("extract_sentences", f"""WITH {STRUCTURE_SQL}, {selection_sql('st', *CHUNK_BOUNDS, 'doc_id, chunk_no')}
SELECT doc_id, chunk_no, coalesce(extract, '') AS extract, {count_sql("coalesce(extract, '')")} AS words FROM st LEFT JOIN xe USING (doc_id, chunk_no)""")
def extract_sentences(spark, sf):
    """Extract of every structure chunk by the tier targets."""
    df = hold(docs(spark, sf), chunks=C.structure_chunks(F.col("text")))
    chunks = df.select("doc_id", F.posexplode("chunks").alias("pos", "chunk"))
    held = hold(chunks, extract=E.extract(F.col("chunk"), F.col("pos") + 1))
    return held.select("doc_id", (F.col("pos") + 1).alias("chunk_no"), "extract",
                       T.word_count(F.col("extract")).alias("words"))


def _long_documents(spark, sf):
    d = hold(docs(spark, sf), total_words=T.word_count(F.col("text")))
    return d.filter(F.col("total_words") > K.TIER_BOUNDS[0])


FIRST_PASS_SQL = f"""{CHUNKS_SQL},
lc AS (SELECT ch.* FROM ch JOIN documents d USING (doc_id) WHERE {WORDS_SQL.replace('text', 'd.text')} > 600),
{selection_sql('lc', f"floor({count_sql('chunk')} * ({SHARE_SQL} * 0.75::DOUBLE))",
               f"floor({count_sql('chunk')} * ({SHARE_SQL} * 1.25::DOUBLE))", 'doc_id, chunk_no')}"""


@query("tier3_first_pass", f"WITH {FIRST_PASS_SQL} SELECT doc_id, chunk_no, extract, {count_sql('extract')} AS words FROM xe")
def tier3_first_pass(spark, sf):
    """Share extraction over the 1,000-word chunks of every document above the first tier."""
    df = hold(_long_documents(spark, sf), chunks=C.sentence_chunks(F.col("text")))
    chunks = df.select("doc_id", F.posexplode("chunks").alias("pos", "chunk"))
    held = hold(chunks, extract=E.extract_share(F.col("chunk"), M.chunk_share(F.col("pos") + 1)))
    return held.select("doc_id", (F.col("pos") + 1).alias("chunk_no"), "extract",
                       T.word_count(F.col("extract")).alias("words"))


REDUCE_TARGET = 200


@query("summaries_tier3", f"""WITH {FIRST_PASS_SQL},
fp AS (SELECT doc_id, string_agg(extract, ' ' ORDER BY chunk_no) AS chunk FROM xe JOIN documents d USING (doc_id)
  WHERE {WORDS_SQL.replace('text', 'd.text')} > 2500 AND {WORDS_SQL.replace('text', 'd.text')} <= 20000 GROUP BY doc_id),
fn AS (SELECT *, {count_sql('chunk')} AS n FROM fp), long AS (SELECT * FROM fn WHERE n > 2250),
{selection_sql('long', "floor(n * greatest(0.15::DOUBLE, 1500::DOUBLE / n * 0.75::DOUBLE))",
               "floor(n * greatest(0.15::DOUBLE, 1500::DOUBLE / n * 1.25::DOUBLE))", 'doc_id', 'y')},
fe AS (SELECT doc_id, coalesce(ye.extract, fn.chunk) AS e FROM fn LEFT JOIN ye USING (doc_id))
SELECT doc_id, {count_sql('e')} AS extract_words, '[BART summary (480-600 words)]: ' ||
  array_to_string((regexp_extract_all(e, '{K.WORD_SPELLED}'))[1:480], ' ') || '...' AS summary FROM fe""")
def summaries_tier3(spark, sf):
    """Third-tier documents; the SQL states the first pass and one dependent pass."""
    d = hold(docs(spark, sf), total_words=T.word_count(F.col("text"))).withColumn("summary", F.lit(None).cast("string"))
    return U.summarise(U.pending(d, tier=3).select("doc_id", "text")).select("doc_id", "extract_words", "summary")


@query("structure_chunk_words", f"""SELECT doc_id, {WORDS_SQL} AS words, md5(array_to_string(regexp_extract_all(text, '{K.WORD_SPELLED}'), ' ')) AS digest,
  true AS all_fit FROM documents""")
def structure_chunk_words(spark, sf):
    """What structure chunks must keep: every word once and in order, and the limit."""
    df = hold(docs(spark, sf), chunks=C.structure_chunks(F.col("text")))
    df = hold(df, kept=F.flatten(F.transform("chunks", T.words)), all_fit=F.forall(
        "chunks", lambda c: T.word_count(c) <= K.MAX_TOKENS))
    return df.select("doc_id", F.size("kept").cast("long").alias("words"),
                     F.md5(F.array_join("kept", " ")).alias("digest"), "all_fit")


@query("tier3_reduced", f"""WITH lc AS (SELECT doc_id, text AS chunk, {WORDS_SQL} AS n FROM documents WHERE {WORDS_SQL} > 600),
{selection_sql('lc', f"floor(n * greatest(0.15::DOUBLE, {REDUCE_TARGET}.0::DOUBLE / n * 0.75::DOUBLE))",
               f"floor(n * greatest(0.15::DOUBLE, {REDUCE_TARGET}.0::DOUBLE / n * 1.25::DOUBLE))", 'doc_id')}
SELECT doc_id, extract, {count_sql('extract')} AS words FROM xe""")
def tier3_reduced(spark, sf):
    """One dependent pass towards 200 words, so that every longer document takes part."""
    held = hold(_long_documents(spark, sf), extract=E.reduce_to(F.col("text"), F.lit(float(REDUCE_TARGET))))
    return held.select("doc_id", "extract", T.word_count(F.col("extract")).alias("words"))


IDF_SQL = f"""fr AS (SELECT token, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '{K.WORD_TOKEN}')) AS token FROM documents) GROUP BY token),
idf AS (SELECT token, ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (df + 1)) + 1 AS idf FROM fr)"""


def _reduced_sql(source: str, name: str, p: str, score: str) -> str:
    """One dependent pass over (doc_id, words, chunk): those well over their goal are reduced, the others stay."""
    reduced = lambda f: f"floor(n * greatest(0.15::DOUBLE, goal / n * {f}::DOUBLE))"
    return f"""{p}g AS (SELECT *, {count_sql('chunk')} AS n, CASE WHEN words <= 20000 THEN 1500::DOUBLE ELSE 2500::DOUBLE END AS goal FROM {source}),
{p}h AS (SELECT * FROM {p}g WHERE n > goal * 1.5::DOUBLE),
{selection_sql(p + 'h', reduced(0.75), reduced(1.25), 'doc_id', p, score)},
{name} AS (SELECT doc_id, words, coalesce(extract, chunk) AS chunk FROM {p}g LEFT JOIN {p}e USING (doc_id))"""


def summaries_sql(score: str) -> str:
    """The whole flow: structure chunks for the second tier; for the others a first pass and as many as three dependent ones."""
    share = lambda f: f"floor({count_sql('chunk')} * ({SHARE_SQL} * {f}::DOUBLE))"
    k = "greatest(300, least(floor(size * 0.3::DOUBLE), 600))"
    return f"""WITH {IDF_SQL}, {CHUNKS_SQL}, {STRUCTURE_SQL},
wo AS (SELECT doc_id, text, {WORDS_SQL} AS words FROM documents),
ta AS (SELECT st.* FROM st JOIN wo USING (doc_id) WHERE words > 600 AND words <= 2500),
{selection_sql('ta', *CHUNK_BOUNDS, 'doc_id, chunk_no', 'k', score)},
tb AS (SELECT doc_id, string_agg(coalesce(extract, ''), ' ' ORDER BY chunk_no) AS chunk FROM ta LEFT JOIN ke USING (doc_id, chunk_no) GROUP BY doc_id),
tc AS (SELECT ch.*, words FROM ch JOIN wo USING (doc_id) WHERE words > 2500),
{selection_sql('tc', share(0.75), share(1.25), 'doc_id, chunk_no', 'm', score)},
td AS (SELECT doc_id, any_value(words) AS words, string_agg(coalesce(extract, ''), ' ' ORDER BY chunk_no) AS chunk FROM tc LEFT JOIN me USING (doc_id, chunk_no) GROUP BY doc_id),
{_reduced_sql('td', 'te', 'u', score)},
{_reduced_sql('te', 'tf', 'v', score)},
{_reduced_sql('tf', 'tg', 'z', score)},
al AS (SELECT doc_id, words, CASE WHEN words = 0 THEN NULL WHEN words <= 600 THEN text ELSE coalesce(tb.chunk, tg.chunk, '') END AS extract,
  CASE WHEN words <= 600 THEN 1 WHEN words <= 2500 THEN 2 WHEN words <= 20000 THEN 3 ELSE 4 END AS tier
  FROM wo LEFT JOIN tb USING (doc_id) LEFT JOIN (SELECT doc_id, chunk FROM tg) tg USING (doc_id)),
si AS (SELECT *, {count_sql('extract')} AS extract_words, CASE WHEN tier <= 2 THEN {count_sql('extract')} ELSE words END AS size FROM al),
bo AS (SELECT *, (CASE WHEN size <= 150 THEN 15 WHEN size <= 300 THEN 50 WHEN size <= 600 THEN 100 WHEN size <= 2500 THEN floor({k} * 0.6::DOUBLE)
    WHEN size <= 20000 THEN 480 ELSE 600 END)::BIGINT AS lo,
  (CASE WHEN size <= 150 THEN 50 WHEN size <= 300 THEN 100 WHEN size <= 600 THEN 200 WHEN size <= 2500 THEN floor({k} * 0.8::DOUBLE)
    WHEN size <= 20000 THEN 600 ELSE 800 END)::BIGINT AS hi FROM si),
su AS (SELECT *, CASE WHEN tier = 4 THEN '[LongformerBART summary (' ELSE '[BART summary (' END || lo || '-' || hi || ' words)]: ' ||
  array_to_string((regexp_extract_all(extract, '{K.WORD_SPELLED}'))[1:lo], ' ') || '...' AS summary FROM bo)
SELECT doc_id, tier, CASE WHEN words = 0 THEN 'empty' ELSE 'done' END AS status, words AS total_words, extract_words, summary,
  CASE WHEN summary IS NOT NULL THEN {count_sql('summary')} END AS summary_word_count,
  CASE WHEN words > 0 THEN round({count_sql('summary')} / words, 6) ELSE 0 END AS compression_ratio FROM su"""


def _digest(df):
    return df.select("doc_id", "tier", "status", "total_words", "extract_words", "summary", "summary_word_count",
                     F.round("compression_ratio", 6).alias("compression_ratio"))


@query("summaries", summaries_sql("terms"))
def summaries(spark, sf):
    """The whole flow, inside the row."""
    return _digest(U.summarise(docs(spark, sf)))


@query("summaries_tfidf", summaries_sql("tfidf"))
def summaries_tfidf(spark, sf):
    """The whole flow with sentences scored by TF-IDF over the corpus in every pass."""
    d = docs(spark, sf)
    return _digest(U.summarise_scored(d, "doc_id", "text", E.by_tfidf(d)))


@query("summaries_model", summaries_sql("length"))
def summaries_model(spark, sf):
    """The whole flow with a scorer in Python, as a model would be: here it scores a sentence by its length."""
    return _digest(U.summarise_scored(docs(spark, sf), "doc_id", "text", E.by_batches(lambda s: s.str.len())))


SHORT_SQL = f"""n AS (SELECT doc_id, regexp_extract_all(text, '{K.WORD_SPELLED}') AS w, {WORDS_SQL} AS words FROM documents),
b AS (SELECT *, CASE WHEN words <= 150 THEN 15 WHEN words <= 300 THEN 50 ELSE 100 END AS lo,
  CASE WHEN words <= 150 THEN 50 WHEN words <= 300 THEN 100 ELSE 200 END AS hi FROM n WHERE words BETWEEN 1 AND 600),
s AS (SELECT doc_id, words AS total_words, '[BART summary (' || lo || '-' || hi || ' words)]: ' || array_to_string(w[1:lo], ' ') || '...' AS summary FROM b),
t AS (SELECT *, {count_sql('summary')} AS summary_word_count FROM s)"""


@query("summaries_tier1", f"WITH {SHORT_SQL} SELECT doc_id, total_words, summary, summary_word_count, round(summary_word_count / total_words, 6) AS compression_ratio FROM t")
def summaries_tier1(spark, sf):
    d = hold(docs(spark, sf), total_words=T.word_count(F.col("text")))
    d = d.withColumn("summary", F.lit(None).cast("string"))
    rows = U.pending(d, tier=1).select("doc_id", "text")
    return U.summarise(rows).select("doc_id", "total_words", "summary", "summary_word_count",
                                    F.round("compression_ratio", 6).alias("compression_ratio"))


@query("summary_stats", f"""WITH {SHORT_SQL} SELECT count(*)::BIGINT AS n_docs, round(avg(total_words), 6) AS avg_words,
  round(avg(summary_word_count), 6) AS avg_summary_words, round(avg(summary_word_count / total_words), 6) AS avg_ratio FROM t""")
def summary_stats(spark, sf):
    d = hold(docs(spark, sf), total_words=T.word_count(F.col("text")))
    rows = d.filter(F.col("total_words").between(1, K.TIER_BOUNDS[0])).select("doc_id", "text")
    return U.run_statistics(U.summarise(rows))


def processed(spark, sf):
    """Processed documents; those with a quality label count as summarised."""
    d = L.with_lengths(docs(spark, sf)).select("doc_id", F.col("words").alias("total_words"))
    j = d.join(load(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    has = F.col("quality").isNotNull()
    return j.select(
        "doc_id", "total_words", F.when(has, F.concat(F.lit("summary "), F.col("quality").cast("string"))).alias("summary"),
        F.when(has, F.lit(2)).cast("long").alias("summary_word_count"),
        F.when(has, M.compression_ratio(F.lit(2), F.col("total_words"))).alias("compression_ratio"))


@query("pending_by_tier", "WITH " + LENGTHS_SQL + ", p AS (SELECT doc_id, words FROM lengths ANTI JOIN labels USING (doc_id))\n" + "\nUNION ALL\n".join(
    f"(SELECT {t} AS tier, doc_id, words AS total_words FROM p WHERE {c} ORDER BY doc_id LIMIT 25)"
    for t, c in ((1, "words <= 600 AND words > 0"), (2, "words > 600 AND words <= 2500"),
                 (3, "words > 2500 AND words <= 20000"), (4, "words > 20000"))))
def pending_by_tier(spark, sf):
    """The next 25 documents of every tier, from one pass over the texts."""
    rows = materialise(processed(spark, sf).select("doc_id", "total_words", "summary"), "pending")
    parts = [U.pending(rows, t, 25, "doc_id").select(F.lit(t).alias("tier"), "doc_id", "total_words") for t in (1, 2, 3, 4)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("apply_summary_update", f"""WITH {LENGTHS_SQL}
SELECT doc_id, words AS total_words, CASE WHEN doc_id % 3 = 0 THEN 'new ' || doc_id WHEN quality IS NOT NULL THEN 'summary ' || quality END AS summary,
  CASE WHEN doc_id % 3 = 0 THEN 2 WHEN quality IS NOT NULL THEN 2 END::BIGINT AS summary_word_count,
  round(CASE WHEN doc_id % 3 = 0 OR quality IS NOT NULL THEN CASE WHEN words > 0 THEN 2 / words ELSE 0 END END, 6) AS compression_ratio
FROM lengths LEFT JOIN labels USING (doc_id)""")
def apply_summary_update(spark, sf):
    rows = processed(spark, sf)
    new = rows.filter(F.col("doc_id") % 3 == 0).select(
        "doc_id", F.concat(F.lit("new "), F.col("doc_id").cast("string")).alias("summary"),
        F.lit(2).cast("long").alias("summary_word_count"),
        M.compression_ratio(F.lit(2), F.col("total_words")).alias("compression_ratio"))
    return U.apply_update(rows, new, "doc_id").withColumn("compression_ratio", F.round("compression_ratio", 6))
