"""Quality rules with a hashed n-gram likelihood ratio (operator 6): built-in functions only.

Base rules count words, symbols, repeated lines and words inside repeated five-word windows; a
document fails them with under ``MIN_WORDS`` words or when over ``MAX_REPEAT_PERCENT`` percent of
its words are in repeated windows. The method's verdict on the rest: every word and word pair
(A-Z lower-cased) falls into one of ``BUCKETS`` hash buckets; two multinomials over the buckets are counted, one
over all documents (raw) and one over trusted documents (target); a document's score is the sum of
ln(target / raw) over its features, divided by their number. It is kept if that is at
least ``THRESHOLD``, the same for every document: nothing is drawn at random.

The target is fitted on at most ``TRUSTED_ROWS`` labelled rows (quality 1, toxic 0), those with
the smallest hash of doc_id; that bound is also what makes their ids fit a broadcast. The raw
counts come from all documents. Both are smoothed by ``PRIOR`` raw features per bucket, of which
the trusted documents are given their overall share: a bucket that was hardly seen says little,
and an empty label table gives ratios of 0.

Defined results: a null or empty text has no words and fails the base rules; a null doc_id is
scored and never trusted; labels with nulls are no trust, and of repeated labels the worst
counts; repeated rows are scored each; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import common as C
from docloom.llm.registry import query
from docloom.session import materialise
from docloom.sources.tables import load

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
BUCKETS = 1 << 16
TRUSTED_ROWS = 20_000
PRIOR = 100.0
THRESHOLD = -0.12


def repeated_words(words: Column) -> Column:
    """Words inside windows of five that occur twice or more in the text."""
    def windows(h: Column) -> Column:
        last = F.greatest(F.size(h) - WINDOW, F.lit(-1))
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def covered(v: Column) -> Column:
        placed = F.sort_array(F.transform(v, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = F.filter(s, lambda e, j: (F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False)))
                            | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)))
            return F.sort_array(F.transform(same, lambda e: e["i"]))

        def reach(p: Column) -> Column:
            steps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

        return C.bind(placed, lambda s: C.bind(starts(s), reach))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return C.bind(hashes, lambda h: C.bind(windows(h), lambda v: F.when(
        F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(covered(v))))


def measures(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the array __words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(C.WORD))
    rows = docs.withColumn("__words", C.words(F.col("text")))
    rows = rows.select(
        "*", F.size("__words").cast("long").alias("n_words"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        C.bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("__words")).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def features(words: Column) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    def both(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.when(F.get(h, i + 1).isNotNull(), F.xxhash64(x, F.get(h, i + 1))))
        return F.transform(F.concat(h, F.filter(pairs, lambda x: x.isNotNull())), lambda x: x.bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))

    return C.bind(F.transform(words, lambda w: F.xxhash64(C.ascii_lower(w))), both)


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    worst = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("quality"), F.max(F.coalesce("toxic", F.lit(1))).alias("toxic"))
    good = worst.filter((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id")
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).withColumn("__trusted", F.lit(1))


def ratios(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """ln(target / raw) per bucket."""
    trusted = F.broadcast(trusted_ids(labels))  # at most TRUSTED_ROWS rows
    rows = docs.select("doc_id", "text").join(trusted, "doc_id", "left")
    found = rows.select("__trusted", F.explode(features(C.words(F.col("text")))).alias("bucket"))
    counts = found.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("__trusted").alias("target"))
    counts = materialise(counts, "ngram-counts")  # BUCKETS rows; both uses below read them
    everything = counts.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets"))  # one row
    rows = counts.crossJoin(F.broadcast(everything))
    share = F.col("targets") / F.col("raws")
    ratio = (F.col("target") + PRIOR * share) / ((F.col("raw") + PRIOR) * share)
    return rows.select("bucket", F.when(F.col("targets") > 0, F.ln(ratio)).otherwise(F.lit(0.0)).alias("ratio"))


def scored(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Adds score, the mean ratio of a document's features; null if it has none. ``table``: one row per bucket, of which there are BUCKETS."""
    dense = rows.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket").join(table, "bucket", "left")
    one = dense.agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", F.coalesce("ratio", F.lit(0.0)).alias("ratio")))),
                                lambda x: x["ratio"]).alias("ratios")).scalar()
    mean = C.bind(features(F.col("__words")), lambda f: F.when(
        F.size(f) > 0, F.aggregate(f, F.lit(0.0), lambda a, b: a + F.get(F.col("__ratios"), b)) / F.size(f)))
    return rows.withColumn("__ratios", one).withColumn("score", mean).drop("__ratios")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Adds the counts, base_failed, score and kept to every document; columns of these names are replaced."""
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    rows = scored(measures(docs.drop(*added)), ratios(docs, labels))
    kept = ~F.col("base_failed") & (F.coalesce("score", F.lit(0.0)) >= threshold)
    return rows.withColumn("kept", kept).drop("__words")


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The kept documents, with the columns that came in."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "doc_id", "text")
    return quality(rows, labels, threshold).filter("kept").select("row.*")


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return quality(docs, load(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
