"""Chunking, selection and summaries against plain Python, on whole tables and on fixtures."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.arrays import hold
from docloom.operators import chunking as C
from docloom.operators import extraction as E
from docloom.operators import summary as U
from docloom.plans import catalog
from tests import checkers as P

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def structured(n=20):
    part = "\n\n".join(
        f"SECTION {i}. Title {i}\nThis is the first sentence of section {i}. It has some words. It ends here."
        for i in (1, 2, 3))
    return "\n\n".join([part] * n)


HARD = [
    structured(), "", "   ", "one", "x " * 700, "A. " * 300 + "b " * 900 + "! After it. " * 3,
    "intro text\n\n1. First point here\n" + "word " * 400 + "\n2. Second point\n" + "more " * 400,
    "ALL CAPS HEADER\nbody " + "b " * 300 + "\nSECOND HEADER\nbody " + "c " * 600,
    "\n\n".join("p%d " % i + "w " * 200 for i in range(9)), "w " * 300 + "\n\n" + "v " * 1200 + "\n\nend",
]


def test_structure_chunks(spark, texts):
    rows = list(texts.items()) + [(-1 - i, t) for i, t in enumerate(HARD)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(8)
    for limit in (514, 60):
        got = {r.id: r.c for r in df.select("id", C.structure_chunks(F.col("text"), limit).alias("c")).collect()}
        for i, t in rows:
            assert got[i] == P.structure_chunks(t, limit), (i, limit)
            assert [w for c in got[i] for w in c.split()] == t.split()
            assert all(len(c.split()) <= limit for c in got[i])


def test_extracts(spark, texts):
    df = spark.createDataFrame([(i, t, k) for i, t in texts.items() for k in (1, 3, 7)], "id long, text string, k int").repartition(8)
    got = df.select("id", "k", E.extract(F.col("text"), F.col("k")).alias("e"),
                    E.extract_share(F.col("text"), F.lit(0.2)).alias("s"),
                    E.reduce_to(F.col("text"), F.lit(100.0)).alias("r")).collect()
    for r in got:
        t = texts[r.id]
        assert r.e == P.extract(t, r.k)
        assert r.s == P.extract_share(t, 0.2)
        assert r.r == P.reduce_to(t, 100)


def test_summaries(spark, texts):
    book = " ".join(f"Sentence {i} of the book says {'more and ' * (i % 9)}less." for i in range(9000))
    long = {10**6: " ".join(texts.values())[:400000], 10**6 + 1: "word " * 70000, 10**6 + 2: "", 10**6 + 3: book}
    assert len(book.split()) > 100_000
    rows = {**texts, **long}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(8)
    got = {r.doc_id: r for r in U.summarise(df).collect()}
    for i, t in rows.items():
        assert got[i].summary == P.summary(t), i
    assert got[10**6].tier == 4
    assert got[10**6 + 1].status == "done" and got[10**6 + 2].status == "empty"


def test_structured_text_shrinks_at_every_step(spark):
    df = spark.createDataFrame([(1, structured())], "doc_id long, text string")
    r = hold(df, chunks=C.structure_chunks(F.col("text"), 100)).first()
    assert len(r.chunks) > 1
    out = U.summarise(df).first()
    assert out.tier == 2
    assert out.summary_word_count < out.extract_words <= out.total_words


def test_scorer_and_generator_can_be_pandas_udfs(spark, texts):
    @F.pandas_udf("double")
    def length_score(s: pd.Series) -> pd.Series:
        return s.str.len().astype(float)

    @F.pandas_udf("string")
    def shout(text: pd.Series, low: pd.Series, high: pd.Series, model: pd.Series) -> pd.Series:
        return model + ":" + text.str.upper().str.slice(0, 20)

    df = spark.createDataFrame(list(texts.items())[:40], "doc_id long, text string")
    chunks = df.select("doc_id", F.lit(1).alias("number"), F.col("text").alias("chunk"))
    got = E.extract_scored(E.with_scorer(chunks, length_score, "doc_id", "number"), "doc_id", "number").collect()
    assert len(got) == len([t for t in list(texts.values())[:40] if P.sentences(t)])
    for r in got:
        ss = set(P.sentences(texts[r.doc_id]))
        assert any(r.extract.startswith(s) for s in ss)
    out = U.summarise(df, generator=shout).filter("tier = 1").collect()
    assert all(r.summary == "BART:" + texts[r.doc_id].upper()[:20] for r in out)


def test_query_rows_match_checker(spark, texts):
    got = {}
    for r in catalog.QUERIES["extract_sentences"](spark, FOLDER).collect():
        got.setdefault(r.doc_id, {})[r.chunk_no] = r.extract
    for i, t in texts.items():
        want = {k: P.extract(c, k) for k, c in enumerate(P.structure_chunks(t, 514), 1)}
        assert got.get(i, {}) == want


def test_one_scorer_through_every_tier(spark, texts):
    book = " ".join(f"Sentence {i} of the book says {'more and ' * (i % 9)}less." for i in range(9000))
    rows = [*list(texts.items())[:60], (10**6, book), (10**6 + 1, ""), (10**6 + 2, " .. ! ? " * 900 + "one two. " * 700), (10**6 + 3, structured(40)), (10**6 + 4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    columns = ["tier", "extract", "summary", "summary_word_count", "compression_ratio", "status"]
    want = {r.doc_id: [r[c] for c in columns] for r in U.summarise(df).collect()}
    assert {r[0] for r in want.values()} == {1, 2, 3, 4}
    out = U.summarise_scored(df, "doc_id", "text", E.by_expression())
    assert {r.doc_id: [r[c] for c in columns] for r in out.collect()} == want
    in_python = E.by_batches(lambda s: s.map(P.score))
    out = U.summarise_scored(df, "doc_id", "text", in_python)
    assert {r.doc_id: [r[c] for c in columns] for r in out.collect()} == want
    scored = U.summarise_scored(df, "doc_id", "text", E.by_tfidf(df)).collect()
    assert {r.doc_id: r.tier for r in scored} == {d: w[0] for d, w in want.items()}
    for r in scored:
        if r.tier == 3 or r.tier == 4:
            assert r.extract_words < r.total_words


def test_scores_keep_their_places(spark):
    df = spark.createDataFrame([(1, "One two. ?! Three. Two two two."), (2, ""), (3, None)], "k long, text string")
    s = df.select("k", T.sentences(F.col("text")).alias("s"))
    got = {r.k: r.x for r in E.by_tfidf(df)(s, ["k"], "s", "x").collect()}
    assert [x > 0 for x in got[1]] == [True, False, True, True] and not got[2] and not got[3]
    got = {r.k: r.x for r in E.by_batches(lambda t: t.str.len())(s, ["k"], "s", "x").collect()}
    assert got == {1: [8.0, 2.0, 6.0, 12.0], 2: [], 3: []}


def test_structure_chunks_by_any_counter(spark, texts):
    rows = list(texts.items())[:80] + [(-1 - i, t) for i, t in enumerate(HARD)] + [(-99, None)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(8)
    want = {r.id: r.c for r in df.select("id", C.structure_chunks(F.col("text"), 60).alias("c")).collect()}
    for counter in (C.count_by_expression(), C.count_by_batches(lambda t: t.str.split().str.len())):
        got = {r.id: r.c for r in C.structure_chunks_by(df, "text", "c", counter, 60).collect()}
        assert got == want
    # Another measure: every chunk keeps to it, unless one word alone is over it, and no word is lost.
    out = C.structure_chunks_by(df, "text", "c", C.count_by_batches(lambda t: t.str.len()), 200).collect()
    for r in out:
        t = dict(rows)[r.id]
        assert [w for c in r.c for w in c.split()] == (t or "").split()
        assert all(sum(map(len, c.split())) <= 200 or len(c.split()) == 1 for c in r.c)
