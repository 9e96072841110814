"""Length analytics over a table of documents with word and character counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import measures as M
from docloom.functions import text as T
from docloom.functions.arrays import hold
from docloom.operators import quantiles as Q


def with_lengths(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("words", T.word_count(F.col(text))).withColumn("chars", T.char_count(F.col(text)))


def settle(df: DataFrame, column: str) -> DataFrame:
    """Computes a costly column once, ahead of filters on it that would otherwise repeat it per condition."""
    return hold(df, _settled=F.col(column)).drop(column).withColumnRenamed("_settled", column)


def tier_distribution(df: DataFrame, words: str = "words") -> DataFrame:
    """Documents per tier, ordered by the shortest member; unknown lengths are left out."""
    return (
        df.filter(F.col(words).isNotNull())
        .groupBy(M.tier_label(F.col(words)).alias("tier"))
        .agg(F.count(F.lit(1)).alias("n_docs"), F.min(words).alias("min_words"))
        .orderBy("min_words")
    )


def corpus_stats(df: DataFrame, words: str = "words") -> DataFrame:
    return df.filter(F.col(words).isNotNull()).agg(
        F.count(F.lit(1)).alias("total_docs"),
        F.round(F.avg(words), 6).alias("avg_words"),
        F.min(words).alias("min_words"),
        F.max(words).alias("max_words"),
    )


def _null_safe_join(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    cond = F.lit(True)
    for k in by:
        cond = cond & left[k].eqNullSafe(right[k])
    joined = left.join(right, cond, how)
    for k in by:
        joined = joined.drop(right[k])
    return joined


def describe(df: DataFrame, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles, max of every measure, one row per (group, measure)."""
    long = _long_form(df, measures, by)
    by = [*by, "measure"]
    counts = Q.value_counts(long, by, "value")
    base = counts.groupBy(*by).agg(*[c.alias(k) for k, c in Q.moments("value").items()])
    quarts = Q.percentiles(counts, by, "value", (0.25, 0.5, 0.75))
    return _null_safe_join(base, quarts, by).select(
        *by, "count", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min",
        F.round("p0", 6).alias("p25"), F.round("p1", 6).alias("p50"), F.round("p2", 6).alias("p75"), "max",
    )


def profile(df: DataFrame, by: str = "form") -> DataFrame:
    """The 17-measure profile per group: eight word measures, nine character measures."""
    long = df.filter(F.col(by).isNotNull()).select(
        by,
        F.explode(F.array(
            F.struct(F.lit("word").alias("measure"), F.col("words").alias("value")),
            F.struct(F.lit("char").alias("measure"), F.col("chars").alias("value")),
        )).alias("m"),
    ).select(by, "m.measure", "m.value")
    counts = Q.value_counts(long, [by, "measure"], "value")
    base = counts.groupBy(by, "measure").agg(*[c.alias(k) for k, c in Q.moments("value").items()])
    quants = Q.percentiles(counts, [by, "measure"], "value", (0.25, 0.5, 0.75, 0.95))
    both = base.join(quants, [by, "measure"])

    def pick(measure, column):
        return F.max(F.when(F.col("measure") == measure, F.col(column)))

    cols = []
    for measure in ("word", "char"):
        for name, column in (("mean", "mean"), ("median", "p1"), ("std", "std"), ("min", "min"),
                             ("max", "max"), ("count", "count"), ("25th", "p0"), ("75th", "p2")):
            value = pick(measure, column)
            if name not in ("min", "max", "count"):
                value = F.round(value, 6)
            cols.append(value.alias(f"{measure}_{name}"))
    cols.append(F.round(pick("char", "p3"), 6).alias("char_95th"))
    return both.groupBy(by).agg(*cols)


def _long_form(df: DataFrame, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per (document, measure), so that one scan of the texts feeds every measure."""
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("long").alias("value")) for m in measures])
    return df.select(*by, F.explode(cells).alias("m")).select(*by, "m.measure", "m.value").filter(
        F.col("value").isNotNull())


def corpus_percentiles(df: DataFrame, measures: Sequence[str], probs: Sequence[float]) -> DataFrame:
    counts = Q.value_counts(_long_form(df, measures), ["measure"], "value")
    return Q.percentiles(counts, ["measure"], "value", probs).select(
        "measure", *[F.round(f"p{i}", 6).alias(f"p{round(p * 100)}") for i, p in enumerate(probs)])


def form_report(df: DataFrame, threshold: int, prob: float = 0.9) -> DataFrame:
    """Size, percentile of words and characters, and long documents, from one table of counts."""
    counts = Q.value_counts(_long_form(df, ("words", "chars")), ["measure"], "value")
    is_words = F.col("measure") == "words"
    sizes = counts.groupBy("measure").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("value") > threshold, F.col("n")).otherwise(0)).alias("n_long"))
    both = _null_safe_join(sizes, Q.percentiles(counts, ["measure"], "value", (prob,)), ["measure"])
    name = f"p{round(prob * 100)}"
    pick = lambda cond, c: F.max(F.when(cond, F.col(c)))
    return both.agg(
        pick(is_words, "n").alias("n_docs"), F.round(pick(is_words, "p0"), 6).alias(f"words_{name}"),
        F.round(pick(~is_words, "p0"), 6).alias(f"chars_{name}"), pick(is_words, "n_long").alias("n_long"))


def average_by(df: DataFrame, by: str = "form", measure: str = "words") -> DataFrame:
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.round(F.avg(measure), 6).alias(f"avg_{measure}"))


def long_documents(df: DataFrame, threshold: int, by: str | None = None) -> DataFrame:
    groups = [by] if by else []
    return df.groupBy(*groups).agg(F.count_if(F.col("words") > threshold).alias("n_long"),
                                   F.count(F.lit(1)).alias("n_docs"))


def report_ranges(df: DataFrame, ranges: Sequence[tuple[int, int]] = K.REPORT_RANGES) -> DataFrame:
    """Share of documents per closed range; every range is shown, percent is over all rows."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("words").between(lo, hi)).alias(f"r{i}") for i, (lo, hi) in enumerate(ranges)],
    )
    rows = F.array(*[
        F.struct(F.lit(f"{lo}-{hi}").alias("range"), F.col(f"r{i}").alias("n_docs"))
        for i, (lo, hi) in enumerate(ranges)
    ])
    return totals.select("total", F.explode(rows).alias("r")).select(
        "r.range", "r.n_docs",
        F.round(F.when(F.col("total") > 0, F.col("r.n_docs") * 100.0 / F.col("total")).otherwise(0.0), 6).alias("percent"),
    )


def histogram(df: DataFrame, measure: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the observed range, the last one closed; empty bins are shown."""
    counts = Q.value_counts(df.filter(F.col(measure).isNotNull()), [], measure)
    edges = counts.agg(F.min(measure).alias("lo"), F.max(measure).alias("hi"))
    # Both bounds travel as one scalar subquery: a single row, whatever the size of the corpus.
    bounds = edges.select(F.struct("lo", "hi")).scalar()
    width = (F.col("b.hi") - F.col("b.lo")) / F.lit(bins)
    slot = F.when(F.col("b.hi") == F.col("b.lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col(measure) - F.col("b.lo")) / F.nullif(width, F.lit(0.0))) + 1, F.lit(bins)))
    filled = counts.select(measure, "n", bounds.alias("b")).groupBy(slot.cast("int").alias("bin")).agg(
        F.sum("n").alias("n_docs"))
    slots = edges.select("lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    w = (F.col("hi") - F.col("lo")) / F.lit(bins)
    return slots.join(filled, "bin", "left").select(
        "bin",
        F.round(F.col("lo") + (F.col("bin") - 1) * w, 6).alias("bin_start"),
        F.round(F.col("lo") + F.col("bin") * w, 6).alias("bin_end"),
        F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"),
    )


def boxplot(df: DataFrame, by: str = "form", measure: str = "words") -> DataFrame:
    """Quartiles, whiskers at the outermost data inside 1.5 IQR, and the number beyond them."""
    counts = Q.value_counts(df.filter(F.col(by).isNotNull()), [by], measure)
    quarts = Q.percentiles(counts, [by], measure, (0.25, 0.5, 0.75))
    reach = (F.col("p2") - F.col("p0")) * 1.5
    inside = F.col(measure).between(F.col("p0") - reach, F.col("p2") + reach)
    return (
        _null_safe_join(counts, quarts, [by])
        .groupBy(by)
        .agg(
            F.round(F.max("p0"), 6).alias("q1"),
            F.round(F.max("p1"), 6).alias("median"),
            F.round(F.max("p2"), 6).alias("q3"),
            F.min(F.when(inside, F.col(measure))).alias("whisker_low"),
            F.max(F.when(inside, F.col(measure))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).cast("long").alias("n_outliers"),
        )
    )


# exp(-z*z/2) is exactly zero in double precision beyond this many bandwidths.
KERNEL_REACH = 39.0


def kernel_density(df: DataFrame, measure: str = "chars", points: int = 1000) -> DataFrame:
    """Gaussian kernel density on an even grid from 0 to the maximum.

    Equal values are counted first.  Each distinct value then contributes only to the grid
    points its kernel can reach before the term underflows to zero, which drops nothing, so the
    work grows with distinct lengths times a narrow band, not with documents times grid.
    """
    counts = Q.value_counts(df.filter(F.col(measure).isNotNull()), [], measure)
    m = Q.moments(measure)
    stats = counts.agg(
        m["count"].alias("n_all"), m["std"].alias("std"), m["max"].alias("top")
    ).select(F.struct(
        F.col("n_all"),
        F.col("top").cast("double").alias("top"),
        (F.col("std") * F.pow(F.col("n_all").cast("double"), F.lit(-0.2))).alias("h"),
    ).alias("s"))
    s = stats.scalar()
    step = F.col("s.top") / F.lit(float(points - 1))
    reach = F.col("s.h") * F.lit(KERNEL_REACH)
    first = F.greatest(F.floor((F.col(measure) - reach) / step), F.lit(0)).cast("int")
    final = F.least(F.ceil((F.col(measure) + reach) / step), F.lit(points - 1)).cast("int")
    z = (F.col("i") * step - F.col(measure)) / F.col("s.h")
    contributions = (
        counts.select(measure, "n", s.alias("s"))
        .filter((F.col("s.h") > 0) & (F.col("s.top") > 0))
        .select(measure, "n", "s", F.explode(F.sequence(first, final)).alias("i"))
        .groupBy("i")
        .agg(F.sum(F.col("n") * F.exp(F.lit(-0.5) * z * z)).alias("mass"))
    )
    grid = stats.select("s", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    return grid.join(contributions, "i", "left").select(
        F.col("i").alias("grid_no"),
        (F.col("i") * step).alias("x"),
        F.coalesce(
            F.col("mass") / (F.col("s.n_all") * F.col("s.h") * F.lit(math.sqrt(2 * math.pi))), F.lit(0.0)
        ).alias("density"),
    )


def density_peaks(density: DataFrame) -> DataFrame:
    """Strict inner maxima of a density grid (a fixed number of points), x cut to an integer."""
    w = Window.partitionBy(F.lit(0)).orderBy("grid_no")
    return (
        density.withColumn("left", F.lag("density").over(w))
        .withColumn("right", F.lead("density").over(w))
        .filter((F.col("density") > F.col("left")) & (F.col("density") > F.col("right")))
        .select("grid_no", F.floor("x").cast("long").alias("breakpoint"))
    )
