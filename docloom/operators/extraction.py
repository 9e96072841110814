"""Sentence scoring and extractive selection."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import measures as M
from docloom.functions import text as T
from docloom.functions.arrays import hold, let, of_each
from docloom.session import materialise

Scorer = Callable[[Column], Column]


def term_norm(sentence: Column) -> Column:
    """Default score: length of the sentence's term-frequency vector, from its sorted terms.

    Row-local, so scoring adds no shuffle.  A blank sentence scores 0.
    """
    terms = F.sort_array(F.regexp_extract_all(F.lower(sentence), F.lit(K.WORD_TOKEN), F.lit(0)))
    empty = F.struct(F.lit("").alias("prev"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("sum"))

    # (r + 1)^2 - r^2 = 2 r + 1: every further occurrence of a term adds that much to the sum.
    def step(acc, t):
        run = F.when(t == acc["prev"], acc["run"] + 1).otherwise(F.lit(0).cast("long"))
        return F.struct(t.alias("prev"), run.alias("run"), (acc["sum"] + 2 * run + 1).alias("sum"))

    return F.aggregate(terms, empty, step, lambda acc: F.sqrt(acc["sum"].cast("double")))


def scored_sentences(text: Column, scorer: Scorer = term_norm) -> Column:
    """array<struct<s, n, score>> in text order."""
    return F.transform(T.sentences(text), lambda s: F.struct(
        s.alias("s"), T.word_count(s).alias("n"),
        F.when(T.strip(s) == "", F.lit(0.0)).otherwise(scorer(s)).alias("score")))


def select_sentences(scored: Column, lower: Column, upper: Column) -> Column:
    """Extract by score.

    Sentences are visited from the highest score.  The first is always taken.  Once `lower`
    words are reached, the visit ends at a score below half of the document's first sentence or
    when `upper` is reached.  A sentence that would pass 1.1 times `upper` is skipped.  The kept
    ones are joined in text order.
    """
    ranked = lambda sc: F.sort_array(F.transform(sc, lambda x, i: F.struct(
        (-x["score"]).alias("rank"), i.alias("i"), x["n"].alias("n"))))
    empty = F.struct(F.lit(0).cast("long").alias("words"),
                     F.array().cast("array<int>").alias("kept"), F.lit(False).alias("done"))

    def pick(sc, lo, hi):
        floor_score = F.get(sc, F.lit(0))["score"] * F.lit(0.5)

        def step(acc, x):
            first = F.size(acc["kept"]) == 0
            stop = ~first & (acc["words"] >= lo) & ((-x["rank"] < floor_score) | (acc["words"] >= hi))
            fits = first | (acc["words"] + x["n"] <= hi * F.lit(1.1))
            take = ~acc["done"] & ~stop & fits
            return F.struct(
                F.when(take, acc["words"] + x["n"]).otherwise(acc["words"]).alias("words"),
                F.when(take, F.concat(acc["kept"], F.array(x["i"]))).otherwise(acc["kept"]).alias("kept"),
                (acc["done"] | stop).alias("done"))

        return F.aggregate(ranked(sc), empty, step, lambda acc: F.sort_array(acc["kept"]))

    return let(scored, lambda sc: let(lower, lambda lo: let(upper, lambda hi: F.array_join(
        F.transform(pick(sc, lo, hi), lambda i: F.get(sc, i)["s"]), " "))))


def extract(text: Column, number: Column, scorer: Scorer = term_norm) -> Column:
    """Extract of a numbered chunk by its tier target; the band is wider for the first two."""
    v = F.when(number <= 2, F.lit(0.25)).otherwise(F.lit(0.2))
    target = M.chunk_target(T.word_count(text), number)
    return let(target, lambda t: select_sentences(
        scored_sentences(text, scorer),
        F.floor(t * (F.lit(1.0) - v)).cast("long"), F.floor(t * (F.lit(1.0) + v)).cast("long")))


def extract_share(text: Column, share: Column, variance: float = 0.25, scorer: Scorer = term_norm) -> Column:
    """Extract of a fixed share of the words, give or take the variance."""
    n = T.word_count(text)
    return select_sentences(
        scored_sentences(text, scorer),
        F.floor(n * (share * F.lit(1 - variance))).cast("long"),
        F.floor(n * (share * F.lit(1 + variance))).cast("long"))


def reduce_to(text: Column, target: Column, smallest: float = 0.15, scorer: Scorer = term_norm) -> Column:
    """One dependent pass: shrink a text that is more than half over its target, else keep it."""

    def shrink(n):
        ratio = target / n
        return select_sentences(
            scored_sentences(text, scorer),
            F.floor(n * F.greatest(F.lit(smallest), ratio * F.lit(0.75))).cast("long"),
            F.floor(n * F.greatest(F.lit(smallest), ratio * F.lit(1.25))).cast("long"))

    return let(T.word_count(text), lambda n: F.when(n > target * F.lit(1.5), shrink(n)).otherwise(text))


# --- scorers for whole passes ---------------------------------------------------------------------

#: Adds a column of scores, one for each of an array of sentences. Called with the frame, its keys, the column of sentences and the new name.
ArrayScorer = Callable[[DataFrame, list[str], str, str], DataFrame]


def by_expression(scorer: Scorer = term_norm) -> ArrayScorer:
    """Scores by an expression of built-in functions."""
    return lambda df, keys, sentences, name: df.withColumn(name, F.transform(sentences, scorer))


def by_batches(score: Callable[[pd.Series], pd.Series]) -> ArrayScorer:
    """Scores by a Python function of many sentences at once, a model for instance; text stays in its row."""

    each = of_each(score, "double")
    return lambda df, keys, sentences, name: df.withColumn(name, each(F.col(sentences)))


#: Tokens that are looked up inside a task, those in most documents; all others are joined.
COMMON_TOKENS = 1 << 18
#: Tokens that are numbers and Python objects at a time.
TOKEN_SLICE = 1 << 20


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(K.WORD_TOKEN), F.lit(0))


def _common(df: DataFrame, most: int) -> tuple[int, pd.DataFrame]:
    """Least document frequency of the common tokens, and these (token, df): at most ``most``."""
    steps = df.groupBy(F.floor(F.log2("df") * 8).alias("step")).agg(F.count(F.lit(1)).alias("tokens"), F.min("df").alias("df"))
    least, held = 1 << 62, 0
    for row in sorted(steps.collect(), key=lambda r: -r["step"]):  # eight rows per doubling of the largest frequency
        held += row["tokens"]
        if held > most:
            break
        least = row["df"]
    return least, df.filter(F.col("df") >= least).toPandas()


WEIGHED = "struct<parts: array<double>, rest: array<struct<pos: int, token: string, tf: int>>>"


def _weigh(common) -> Callable[[Column], Column]:
    """Column function of arrays of the tokens of each sentence: its sum of squared weights over common tokens, and the counts of all other tokens."""

    def part(sentences: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        known, idf = common.value
        flat = sentences.flatten()
        found = (flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat).dictionary_encode()
        owner = np.repeat(np.arange(len(sentences)), pc.list_value_length(sentences).to_numpy(zero_copy_only=False))
        n = max(len(found.dictionary), 1)
        pairs, tf = np.unique(owner * n + found.indices.to_numpy(), return_counts=True)
        place = pc.fill_null(pc.index_in(found.dictionary, known), -1).to_numpy()[pairs % n]
        hot = place >= 0
        sums = np.bincount(pairs[hot] // n, (tf[hot] * idf[place[hot]]) ** 2, len(sentences))
        return sums, pairs[~hot] // n, found.dictionary.take(pa.array(pairs[~hot] % n)), tf[~hot]

    def run(texts: pa.Array) -> pa.Array:
        counts = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        sentences, ends = texts.flatten(), np.cumsum(counts)
        size = np.cumsum(pc.list_value_length(sentences).to_numpy(zero_copy_only=False).astype(np.int64))
        found, lo = [], 0
        while lo < len(sentences):
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + TOKEN_SLICE, side="right")))
            sums, owner, token, tf = part(sentences.slice(lo, hi - lo))
            found.append((sums, owner + lo, token, tf))
            lo = hi
        sums, owner, tokens, tf = zip(*found) if found else ([np.empty(0)], [np.empty(0, np.int64)], [pa.array([], pa.string())], [np.empty(0)])
        owner = np.concatenate(owner)
        offsets = np.concatenate(([0], ends))
        pos = owner - (ends - counts)[np.searchsorted(ends, owner, side="right")]
        rest = pa.StructArray.from_arrays([
            pa.array(pos, pa.int32()), pa.concat_arrays([t.cast(pa.string()) for t in tokens]), pa.array(np.concatenate(tf), pa.int32())], ["pos", "token", "tf"])
        return pa.StructArray.from_arrays([
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(sums), pa.float64())),
            pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, offsets), pa.int32()), rest)], ["parts", "rest"])

    return F.arrow_udf(run, WEIGHED)


def by_tfidf(corpus: DataFrame, text: str = "text", places: int | None = 9, most: int = COMMON_TOKENS) -> ArrayScorer:
    """Scores by the length of a sentence's TF-IDF vector, with document frequencies of the corpus.

    Tokens are counted by sentence inside the row, where the common ones, a bounded number, are weighted too.
    Only the others, none of which can skew a partition, travel as (sentence, token, count) to a shuffle join, and
    only numbers come back: an array of scores for each row, rounded
    to so many places, so that equal sentences score the same in whatever order their parts were added up.
    """
    spark = corpus.sparkSession
    tokens = corpus.select(F.explode(F.array_distinct(_tokens(F.col(text)))).alias("token"))
    df = materialise(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "document-frequencies")
    n_docs = corpus.count()
    least, common = _common(df, most)
    weigh = _weigh(spark.sparkContext.broadcast((
        pa.array(common["token"], pa.string()), np.log((n_docs + 1.0) / (common["df"].to_numpy(np.float64) + 1.0)) + 1.0)))
    rare = df.filter(F.col("df") < least).select("token", (F.log((n_docs + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf"))
    unseen = F.log(F.lit(n_docs + 1.0)) + 1.0

    def add(df: DataFrame, keys: list[str], sentences: str, name: str) -> DataFrame:
        rows = materialise(df.select(*keys, weigh(F.transform(sentences, _tokens)).alias("w")), "weighed-sentences")
        known = rows.select(*keys, F.posexplode("w.parts").alias("pos", "part"))
        other = rows.select(*keys, F.inline("w.rest")).join(rare, "token", "left")
        other = other.select(*keys, "pos", F.pow(F.col("tf") * F.coalesce("idf", unseen), F.lit(2.0)).alias("part"))
        # Dealt by the keys once, for both aggregations and the join.
        parts = known.unionByName(other).repartition(*keys)
        score = F.sqrt(F.sum("part"))
        scores = parts.groupBy(*keys, "pos").agg((score if places is None else F.round(score, places)).alias("score"))
        each = F.sort_array(F.collect_list(F.struct("pos", "score")))
        return df.join(scores.groupBy(*keys).agg(F.transform(each, lambda x: x["score"]).alias(name)), keys, "left")

    return add


def tfidf_scores(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, pos, sentence, score): length of every sentence's TF-IDF vector over the corpus."""
    cut = materialise(docs.select(key, T.sentences(F.col(text)).alias("_s")), "sentences")
    df = by_tfidf(docs, text, places=None)(cut, [key], "_s", "_score")
    return df.select(key, F.posexplode(F.arrays_zip(F.col("_s").alias("s"), F.col("_score").alias("score"))).alias("pos", "_x")).select(
        key, "pos", F.col("_x.s").alias("sentence"), F.col("_x.score").alias("score"))


def extract_units(units: DataFrame, keys: list[str], text: str, lower: Column, upper: Column, scorer: ArrayScorer) -> DataFrame:
    """The units with ``extract``: their sentences scored by any scorer, and selected within the bounds inside the row."""
    df = scorer(units.withColumn("_s", T.sentences(F.col(text))), keys, "_s", "_score")
    scored = F.transform("_s", lambda s, i: F.struct(
        s.alias("s"), T.word_count(s).alias("n"), F.coalesce(F.get("_score", i), F.lit(0.0)).alias("score")))
    df = hold(df, _sc=scored)
    return df.withColumn("extract", select_sentences(F.col("_sc"), lower, upper)).drop("_s", "_score", "_sc")


def with_scorer(chunks: DataFrame, scorer: Scorer, *keys: str, chunk: str = "chunk") -> DataFrame:
    """(keys, pos, sentence, n, score) with any scorer over a sentence column, a pandas UDF included."""
    rows = chunks.select(*keys, F.posexplode(T.sentences(F.col(chunk))).alias("pos", "sentence"))
    return rows.withColumn("n", T.word_count(F.col("sentence"))).withColumn(
        "score", scorer(F.col("sentence")).cast("double"))


def extract_scored(scored: DataFrame, key: str, number: str) -> DataFrame:
    """(key, number, extract) from scored sentence rows; a group is one bounded chunk."""
    item = F.struct("pos", F.col("sentence").alias("s"), "n", "score")
    groups = scored.groupBy(key, number).agg(F.sort_array(F.collect_list(item)).alias("sc"), F.sum("n").alias("words"))
    v = F.when(F.col(number) <= 2, F.lit(0.25)).otherwise(F.lit(0.2))
    target = M.chunk_target(F.col("words"), F.col(number))
    return groups.select(key, number, select_sentences(
        F.col("sc"), F.floor(target * (F.lit(1.0) - v)).cast("long"),
        F.floor(target * (F.lit(1.0) + v)).cast("long")).alias("extract"))
