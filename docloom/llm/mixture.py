"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (operator 1).

Each source's documents stand in the order of a hash, and that order is cut into blocks of
``block_words`` words. A source's target is so many whole passes over it and the head of one more,
which makes an exact quota of blocks per source. A binary tree over the output shards then
splits the quotas: at every node the left half draws its share of the node's blocks without
replacement, a multivariate hypergeometric draw, until a leaf, one shard, is left with a quota
for each source. Shards take their quotas one behind the other from each source's order, so no block
is drawn twice in a pass, and every shard orders what it got by a hash of its own.

The quotas are a table of one row per source (with one boundary per shard); it is what the
tree's task holds. A plan may have up to 10**9 blocks (numpy's bound for the draw), that is
4 * 10**12 words at the default block size; mixes beyond that take larger blocks.

Defined results: a null or empty text has size 0 and is part of a mix as any other, at no words; a null
source is a source of its own, last in the order; rows that are equal in doc_id and text are documents
of their own with adjoining places; an empty table gives no rows; other columns pass through
``mix`` and are not read by ``draws``. Reruns give the same mix.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm import common as C
from docloom.llm.registry import query
from docloom.session import materialise
from docloom.sources.tables import load

#: Weights of the sources in order, repeating; the mix has so many words per word of the input,
#: and at most so many of a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SHARDS = 64
BLOCK_WORDS = 4096
SEED = 20


def sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds size (words) and place, the hash that orders a source."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(C.WORD)), F.lit(0)).cast("long")).withColumn(
        "place", C.hex_hash(F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("text")))


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source: source_size, target. One row per source meets in the windows.

    In order of what a source can give per unit of weight, sources are full as long as the even
    level of those from there on is above what they can give.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    rows = by_source.withColumn("weight", weight).withColumn("full", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    rows = rows.withColumn("total", F.sum("source_size").over(everything) * float(share))
    rows = rows.withColumn("given", F.coalesce(F.sum("full").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    rows = rows.withColumn("open", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    is_full = F.col("full") / F.col("weight") < (F.col("total") - F.col("given")) / F.col("open")
    rows = rows.withColumn("is_full", is_full)
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("is_full"), F.col("full"))).over(everything), F.lit(0.0))
    among = F.sum(F.when(~F.col("is_full"), F.col("weight"))).over(everything)
    return rows.select("source", "source_size",
                       F.when(F.col("is_full"), F.col("full")).otherwise(left * F.col("weight") / among).alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (row) for each shard (column), by the splitting tree."""
    out = np.zeros((len(quotas), shards), dtype=np.int64)
    nodes = [(0, shards, quotas.astype(np.int64))]
    while nodes:
        lo, hi, held = nodes.pop()
        if hi - lo == 1:
            out[:, lo] = held
            continue
        mid = (lo + hi) // 2
        share = int(held.sum()) * (mid - lo) // (hi - lo)
        left = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(held, share, method="marginals")
        nodes += [(lo, mid, left), (mid, hi, held - left)]
    return out


def plan(sized: DataFrame, shards: int, block_words: int, seed: int, **mix) -> DataFrame:
    """Per source: source_size, target, whole passes, words of the last one, blocks, shard ends."""
    t = targets(sized, **mix)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    t = t.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    t = t.withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
    t = t.withColumn("quota", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block_words).cast("long"))

    def tree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        if not held:
            return
        rows = pd.concat(held).sort_values("source", na_position="last", kind="stable").reset_index(drop=True)
        ends = np.cumsum(split_quotas(rows["quota"].to_numpy(), shards, seed), axis=1)
        yield rows.assign(ends=list(ends))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.schema) + ", ends array<long>"
    # A written table: joins see its true size, and the draw is made once.
    return materialise(t.coalesce(1).mapInPandas(tree, schema), "mixture-plan")


def draws(sized: DataFrame, narrow: DataFrame, shards: int = SHARDS, block_words: int = BLOCK_WORDS, seed: int = SEED,
          **mix) -> DataFrame:
    """Adds source_size, target and drawn: an array of (pass, block, shard), one for each time the mix takes the row.

    ``narrow``: doc_id, source, size and place of the same rows.
    """
    planned = plan(narrow, shards, block_words, seed, **mix)
    rows = C.running(sized, "source", "place", "size", "before", narrow)
    rows = rows.select("*", *C.group_keys("source"))
    planned = planned.select(*C.group_keys("source"), "source_size", "target", "passes", "rest", "blocks", "quota", "ends")
    rows = rows.join(planned, C.GROUP_KEYS)
    block = F.floor(F.col("before") / block_words).cast("long")
    # The head of the last pass ends at the document boundary that is nearest to the target.
    more = ((F.col("rest") > 0) & (F.col("before") + F.col("size") / 2 <= F.col("rest"))).cast("long")
    taken = F.col("passes") + more
    passes = F.when(taken > 0, F.sequence(F.lit(0).cast("long"), taken - 1)).otherwise(F.array().cast("array<long>"))

    def draw(k):
        at = F.least(k * F.col("blocks") + block, F.col("quota") - 1)
        return F.struct(k.alias("pass"), block.alias("block"),
                        F.size(F.filter("ends", lambda e: e <= at)).alias("shard"))

    return rows.withColumn("drawn", F.transform(passes, draw)).select(*sized.columns, "source_size", "target", "drawn")


def mix(docs: DataFrame, shards: int = SHARDS, block_words: int = BLOCK_WORDS, seed: int = SEED, **kw) -> DataFrame:
    """The mixed corpus: every row as often as it is taken, with its shard and its place there.

    Sort by (mix_shard, mix_place) to read it; a document taken twice has two places.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "doc_id", "source", "text")
    rows = sizes(rows, seed).drop("text")
    narrow = materialise(rows.drop("row"), "mixture-sizes")
    drawn = draws(rows, narrow, shards, block_words, seed, **kw)
    drawn = drawn.select("row", "place", F.explode("drawn").alias("draw"))
    place = F.xxhash64(F.lit(seed), F.col("draw.shard"), F.col("draw.pass"), F.col("place"))
    return drawn.select("row.*", F.col("draw.shard").alias("mix_shard"), place.alias("mix_place"))


DIGEST = """WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
  {place} AS place, text FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
  2.0::DOUBLE * source_size AS full_size, 1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE AS total FROM s),
l AS (SELECT *, full_size / weight < (total - coalesce(sum(full_size) OVER (ORDER BY full_size / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY full_size / weight, source NULLS LAST
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS is_full FROM w),
t AS (SELECT source, source_size, CASE WHEN is_full THEN full_size ELSE
    (total - coalesce(sum(full_size) FILTER (is_full) OVER (), 0)) * weight / sum(weight) FILTER (NOT is_full) OVER () END AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM t),
r AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT doc_id, size, source_size, target,
  (size * (passes + CASE WHEN target - passes * source_size > 0 AND before + size / 2 <= target - passes * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r JOIN p ON r.source IS NOT DISTINCT FROM p.source""".replace("{place}", C.hex_hash_sql(f"'{SEED}'", "doc_id::VARCHAR", "text"))


@query("op1_mix_sources", DIGEST)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = materialise(sizes(load(spark, sf_dir, "documents")).select("doc_id", "source", "size", "place"), "mixture-sizes")
    return draws(narrow, narrow).select("doc_id", "size", "source_size", "target",
                                        (F.col("size") * F.size("drawn")).alias("taken"))
