"""The most frequent keys, exactly, without shuffling the others.

Keys are hashed to ``BUCKETS`` buckets and the buckets counted: a task sends one number a bucket at most, however many keys there
are. No key occurs more often than its bucket. A lower bound for the k-th best count comes from buckets that hold a single
key, and if that leaves more than ``FEW`` of the rows, from an exact count of the keys in the ``SEEDS`` largest buckets. Then only keys of buckets that reach the bound are counted
one by one: no key that belongs to the result is lost, whatever the hash does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.session import materialise

BUCKETS = 1 << 20
SEEDS = 1 << 10
#: Share of all rows that may be left without trying for a higher bound.
FEW = 0.02


def _counted(items: DataFrame, by: Sequence[str | Column], sums: Sequence[str]) -> DataFrame:
    return items.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(s).alias(s) for s in sums])


def _bound(counts: DataFrame, k: int) -> int | None:
    """The k-th best count; none if there are fewer."""
    best = counts.orderBy(F.desc("n")).limit(k).agg(F.count(F.lit(1)), F.min("n")).first()
    return best[1] if best[0] >= k else None


def reaching(items: DataFrame, key: Sequence[str], k: int, sums: Sequence[str] = (), keep: Column | None = None,
             seeds: int = SEEDS) -> DataFrame:
    """The rows of ``items`` whose key may be among the k most frequent of those that are kept. ``keep`` may use n and the sums."""
    keep = F.lit(True) if keep is None else keep
    hashed = items.withColumn("_h", F.xxhash64(*key)).withColumn("_b", F.pmod("_h", F.lit(BUCKETS)))
    totals = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("n"), F.min("_h").alias("lo"), F.max("_h").alias("hi"), *[F.sum(s).alias(s) for s in sums])
    totals = materialise(totals, "buckets")
    bound = _bound(totals.filter(F.col("lo") == F.col("hi")).filter(keep), k) or 1
    reach, total = totals.agg(F.sum(F.when(F.col("n") >= bound, F.col("n"))), F.sum("n")).first()
    if reach and reach > FEW * total:
        # Too many rows would be left: raise the bound.
        largest = totals.orderBy(F.desc("n")).limit(seeds).select("_b")
        exact = _counted(hashed.join(F.broadcast(largest), "_b", "left_semi"), key, sums).filter(keep)
        bound = max(bound, _bound(exact, k) or 1)
    # BUCKETS numbers at most.
    heavy = totals.filter(F.col("n") >= bound).select("_b")
    return hashed.join(F.broadcast(heavy), "_b", "left_semi").drop("_h", "_b")


def most_frequent(items: DataFrame, key: Sequence[str], k: int, sums: Sequence[str] = (), keep: Column | None = None, ties: Sequence[str] | None = None,
                  seeds: int = SEEDS) -> DataFrame:
    """(key, n, sums) of the k most frequent keys that are kept; equal counts in order of ``ties`` (the key)."""
    counts = _counted(reaching(items, key, k, sums, keep, seeds), key, sums)
    counts = counts if keep is None else counts.filter(keep)
    return counts.orderBy(F.desc("n"), *(ties or key)).limit(k)
