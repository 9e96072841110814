"""Tiered summaries: one lazy plan, row-local from text to summary."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import measures as M
from docloom.functions import text as T
from docloom.functions.arrays import hold
from docloom.operators import chunking as C
from docloom.operators import extraction as E
from docloom.session import materialise

Generator = Callable[[Column, Column, Column, Column], Column]


def pass_numbers(words: Column, target: Column) -> Column:
    """As many dependent passes as a text of so many words can need.

    A pass keeps at most 0.15 times 1.1 of the words, under a sixth, or comes within 1.5 times the
    target; one that cannot (its first sentence is longer) returns what the next would return too.
    """
    steps = F.ceil(F.log(F.greatest(words, F.lit(1)) / target) / F.lit(math.log(6))) + 2
    return F.sequence(F.lit(1).cast("long"), F.greatest(steps, F.lit(1).cast("long")))


def first_pass(text: Column, scorer: E.Scorer = E.term_norm) -> Column:
    """Extract of every 1,000-word chunk by its share, joined."""
    return F.array_join(F.transform(
        C.sentence_chunks(text),
        lambda c, i: E.extract_share(c, M.chunk_share(i + 1), scorer=scorer)), " ")


def by_chunk(text: Column, scorer: E.Scorer = E.term_norm) -> Column:
    """Extract of every structure chunk by its number, joined."""
    return F.array_join(F.transform(
        C.structure_chunks(text), lambda c, i: E.extract(c, i + 1, scorer)), " ")


def pending(docs: DataFrame, tier: int | None = None, limit: int | None = None, key: str = "id") -> DataFrame:
    """Documents without a summary, of one tier or all; the first by key when limited."""
    w = F.col("total_words")
    rows = docs.filter(F.col("summary").isNull())
    if tier == 1:
        rows = rows.filter((w <= K.TIER_BOUNDS[0]) & (w > 0))
    elif tier in (2, 3):
        rows = rows.filter((w > K.TIER_BOUNDS[tier - 2]) & (w <= K.TIER_BOUNDS[tier - 1]))
    elif tier == 4:
        rows = rows.filter(w > K.TIER_BOUNDS[2])
    return rows.orderBy(key).limit(limit) if limit else rows


def summarise(docs: DataFrame, text: str = "text", scorer: E.Scorer = E.term_norm,
              generator: Generator = T.lead_summary) -> DataFrame:
    """Adds tier, extract, summary, summary_word_count, compression_ratio and status.

    Tier 1 goes straight to the generator; tier 2 through structure chunks; tiers 3 and 4
    through a first pass over 1,000-word chunks and dependent passes until the text fits.  Every stage is
    guarded by its tier, so a row pays only for its own.  The generator is a column function
    of (text, low, high, model name) and may wrap a pandas UDF.
    """
    df = hold(docs, total_words=T.word_count(F.col(text)))
    total = F.col("total_words")
    tier = M.tier(total)
    target = F.when(tier == 3, F.lit(float(K.PASS_TARGET[3]))).otherwise(F.lit(float(K.PASS_TARGET[4])))
    # A pass that is no longer needed returns its input at once.
    passes = F.aggregate(
        pass_numbers(total, target), first_pass(F.col(text), scorer),
        lambda e, _: E.reduce_to(e, target, scorer=scorer))
    ok = total > 0
    df = hold(df, tier=tier, extract=F.when(~ok, F.lit(None).cast("string"))
              .when(tier == 1, F.col(text))
              .when(tier == 2, by_chunk(F.col(text), scorer))
              .otherwise(passes))
    return finished(df, generator)


def finished(df: DataFrame, generator: Generator) -> DataFrame:
    """Summaries and their measures from total_words, tier and extract."""
    df = hold(df, extract_words=T.word_count(F.col("extract")))
    total = F.col("total_words")
    # Tiers 1 and 2 take their bounds from the words handed to the generator, 3 and 4 from their tier.
    tier = F.col("tier")
    size = F.when(tier <= 2, F.col("extract_words")).otherwise(total)
    model = F.when(tier == 4, "LongformerBART").otherwise("BART")
    df = hold(df, summary=F.when(F.col("extract").isNotNull(), generator(
        F.col("extract"), M.summary_low(size), M.summary_high(size), model)))
    summary_words = F.when(F.col("summary").isNotNull(), T.word_count(F.col("summary")))
    status = F.when(total == 0, "empty").when(F.col("summary").isNull(), "failed").otherwise("done")
    return df.withColumn("summary_word_count", summary_words).withColumns({
        "compression_ratio": M.compression_ratio(F.col("summary_word_count"), total),
        "status": status,
    })


def summarise_scored(docs: DataFrame, key: str, text: str, scorer: E.ArrayScorer, generator: Generator = T.lead_summary) -> DataFrame:
    """As ``summarise``, with one scorer of any kind (TF-IDF over a corpus, a Python model) for every pass of every tier.

    Such a scorer cannot run inside an expression, so each pass is a step over the texts that still need it, written
    before the next one. The key must be unique and not null.
    """
    df = hold(docs, total_words=T.word_count(F.col(text)))
    df = hold(df, tier=M.tier(F.col("total_words")))
    chunks = F.when(F.col("tier") == 2, C.structure_chunks(F.col(text))).otherwise(C.sentence_chunks(F.col(text)))
    units = hold(df.filter(F.col("tier") > 1).select(key, "tier", text), _c=chunks).select(key, "tier", F.posexplode("_c").alias("_no", "_chunk"))
    units = materialise(units.withColumn("_n", T.word_count(F.col("_chunk"))), "chunks")
    number, n = F.col("_no") + 1, F.col("_n")
    share = M.chunk_share(number)
    v = F.when(number <= 2, F.lit(0.25)).otherwise(F.lit(0.2))

    def bound(sign: int) -> Column:
        # Chunks of the second tier have a target of their own, the others a share of their words.
        target = M.chunk_target(n, number) * (F.lit(1.0) + F.lit(float(sign)) * v)
        return F.floor(F.when(F.col("tier") == 2, target).otherwise(n * (share * F.lit(1 + sign * 0.25)))).cast("long")

    first = E.extract_units(units, [key, "_no"], "_chunk", bound(-1), bound(1), scorer)
    ordered = F.sort_array(F.collect_list(F.struct("_no", "extract")))
    whole = first.groupBy(key, "tier").agg(F.array_join(F.transform(ordered, lambda x: x["extract"]), " ").alias("_e"))
    whole = materialise(whole.withColumn("_n", T.word_count(F.col("_e"))), "pass")
    goal = F.when(F.col("tier") == 3, F.lit(float(K.PASS_TARGET[3]))).otherwise(F.lit(float(K.PASS_TARGET[4])))
    most = df.agg(F.max(F.size(pass_numbers(F.col("total_words"), F.lit(float(min(K.PASS_TARGET.values()))))))).first()[0] or 0
    done = []
    for _ in range(most):
        too_long = (F.col("tier") > 2) & (n > goal * F.lit(1.5))
        done.append(whole.filter(~too_long))
        left = whole.filter(too_long)
        if left.isEmpty():
            break
        ratio = goal / n
        reduced = lambda f: F.floor(n * F.greatest(F.lit(0.15), ratio * F.lit(f))).cast("long")
        whole = E.extract_units(left, [key], "_e", reduced(0.75), reduced(1.25), scorer)
        whole = materialise(whole.select(key, "tier", F.col("extract").alias("_e"), T.word_count(F.col("extract")).alias("_n")), "pass")
    else:
        done.append(whole)
    extracts = done[0]
    for part in done[1:]:
        extracts = extracts.union(part)
    df = df.join(extracts.select(key, "_e"), key, "left").withColumn("extract", F.when(
        F.col("total_words") == 0, F.lit(None).cast("string")).when(F.col("tier") == 1, F.col(text)).otherwise(F.coalesce("_e", F.lit("")))).drop("_e")
    return finished(df, generator)


def run_statistics(df: DataFrame) -> DataFrame:
    """Documents, mean lengths, and the mean of the non-zero ratios."""
    ratio = F.col("compression_ratio")
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_docs"),
        F.round(F.sum("total_words") / n, 6).alias("avg_words"),
        F.round(F.coalesce(F.sum("summary_word_count"), F.lit(0)) / n, 6).alias("avg_summary_words"),
        F.round(F.coalesce(F.avg(F.when(ratio != 0, ratio)), F.lit(0.0)), 6).alias("avg_ratio"))


def apply_update(docs: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Summary columns replaced where an update exists, kept elsewhere."""
    cols = ["summary", "summary_word_count", "compression_ratio"]
    new = updates.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in cols])
    joined = docs.join(new, key, "left")
    for c in cols:
        joined = joined.withColumn(c, F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)))
    return joined.drop("_hit", *[f"_{c}" for c in cols])
