"""Most frequent words and word sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions.arrays import hold
from docloom.operators import heavy as H


def tokens(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def unigram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Alphabetic tokens without stop words; counted with map-side combining."""
    words = docs.select(F.explode(tokens(F.col(text), K.WORD_TOKEN)).alias("token"))
    kept = words.filter(F.col("token").rlike(K.LETTERS_ONLY) & ~F.col("token").isin(*K.STOP_WORDS))
    return kept.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def ngrams(docs: DataFrame, n: int, text: str = "text") -> DataFrame:
    """(ngram, first) of all n-grams over tokens left after the stop words; first is 1 once for each document, else 0.

    The sequences of a document are sorted inside its row, so that the first of each run stands
    for the document.  Document frequency is then a plain sum beside the total, without a shuffle by document.
    """
    kept = F.filter(tokens(F.col(text), K.GRAM_TOKEN), lambda t: ~t.isin(*K.STOP_WORDS))
    rows = hold(docs.select(text), t=kept).filter(F.size("t") >= n)
    # Whole arrays are laid side by side: a slice for each place would cost more than the rest of the row.
    grams = F.slice("t", 1, F.size("t") - (n - 1))
    for k in range(1, n):
        grams = F.zip_with(grams, F.slice("t", 1 + k, F.size("t") - (n - 1)), lambda a, b: F.concat(a, F.lit(" "), b))
    rows = hold(rows.select("t"), g=F.sort_array(grams))
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice("g", 1, F.size("g") - 1))
    marked = F.zip_with("g", before, lambda gram, last: F.struct(
        gram.alias("ngram"), F.when(gram.eqNullSafe(last), F.lit(0)).otherwise(F.lit(1)).alias("first")))
    return rows.select(F.inline(marked))


def ngram_counts(docs: DataFrame, n: int, min_docs: int = 2, text: str = "text") -> DataFrame:
    """Total count and document frequency of all n-grams in enough documents: one shuffle, combined before it."""
    counts = ngrams(docs, n, text).groupBy("ngram").agg(F.count(F.lit(1)).alias("n"), F.sum("first").alias("n_docs"))
    return counts.filter(F.col("n_docs") >= min_docs)


def top_ngrams(docs: DataFrame, n: int, k: int, min_docs: int = 2, text: str = "text") -> DataFrame:
    """The k most frequent n-grams in enough documents; only those that can be among them are shuffled by themselves."""
    best = H.most_frequent(ngrams(docs, n, text), ["ngram"], k, sums=["first"], keep=F.col("first") >= min_docs)
    return best.withColumnRenamed("first", "n_docs")
