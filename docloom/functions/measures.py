"""Numbers derived from word counts: tiers, length targets, shares, ratios, norms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import constants as K


def _ladder(n: Column, bounds, values, last):
    expr = None
    for bound, value in zip(bounds, values):
        cond = n <= bound
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(last)


def tier(n: Column) -> Column:
    return _ladder(n, K.TIER_BOUNDS, [F.lit(1), F.lit(2), F.lit(3)], F.lit(4))


def supported_tier(n: Column) -> Column:
    """Tier, or null beyond the supported length."""
    return F.when(n <= K.SUPPORTED_WORDS, tier(n))


def tier_label(n: Column) -> Column:
    *first, last = [F.lit(x) for x in K.TIER_LABELS]
    return _ladder(n, K.TIER_BOUNDS, first, last)


def extraction_budget(n: Column) -> Column:
    """K = 30 % of the words, held between 300 and 600."""
    share = F.floor(n * F.lit(K.EXTRACT_RATIO)).cast("long")
    return F.greatest(F.lit(K.EXTRACT_MIN), F.least(share, F.lit(K.EXTRACT_MAX))).cast("long")


def summary_low(n: Column) -> Column:
    k = extraction_budget(n)
    b1, b2, b3 = (x[0] for x in K.SHORT_SUMMARY)
    lows = [F.lit(x[1]) for x in K.SHORT_SUMMARY] + [F.floor(k * F.lit(0.6)), F.lit(K.TIER3_SUMMARY[0])]
    return _ladder(n, (b1, b2, b3, *K.TIER_BOUNDS[1:]), lows, F.lit(K.TIER4_SUMMARY[0])).cast("long")


def summary_high(n: Column) -> Column:
    k = extraction_budget(n)
    b1, b2, b3 = (x[0] for x in K.SHORT_SUMMARY)
    highs = [F.lit(x[2]) for x in K.SHORT_SUMMARY] + [F.floor(k * F.lit(0.8)), F.lit(K.TIER3_SUMMARY[1])]
    return _ladder(n, (b1, b2, b3, *K.TIER_BOUNDS[1:]), highs, F.lit(K.TIER4_SUMMARY[1])).cast("long")


def chunk_share(number: Column) -> Column:
    """Share of a chunk to extract, by its 1-based number."""
    shares = F.array(*[F.lit(x) for x in K.CHUNK_SHARES])
    return F.coalesce(F.try_element_at(shares, number.cast("int")), F.lit(K.DEFAULT_SHARE))


def chunk_target(n: Column, number: Column) -> Column:
    """Words to extract from a chunk: all of a short one, its share otherwise."""
    return F.when(n <= K.TIER_BOUNDS[0], n.cast("long")).otherwise(
        F.floor(n * chunk_share(number)).cast("long"))


def balanced_chunk_size(n: Column, smallest: int = K.BALANCED_MIN) -> Column:
    parts = F.greatest(F.lit(1), F.floor(n / K.BALANCED_MAX))
    even = F.floor(n / parts)
    return F.when(n <= smallest, n.cast("long")).otherwise(
        F.greatest(F.lit(smallest), F.least(even, F.lit(K.BALANCED_MAX))).cast("long"))


def compression_ratio(summary_words: Column, total_words: Column) -> Column:
    return F.when(total_words > 0, summary_words / total_words).otherwise(F.lit(0.0))


def l2_norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0).cast("double"),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))
