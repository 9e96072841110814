"""Line de-duplication by a segment-partition edit join (operator 9): built-in functions only.

A line is what stands between line feeds and holds a word. Lines that are equal, and lines of at
least ``MIN_CHARS`` characters within ``EDITS`` edits of each other, directly or over other lines,
form a class; over the whole corpus the first line of a class (by doc_id, then text hash, then
place) stays and every other one goes. Shorter lines only match exactly.

Edit join: a line is cut into EDITS + 1 even segments, so one of them survives any EDITS edits. Each
distinct line is indexed under (its length, segment number, segment). To find those that are up to EDITS
characters shorter, or as long, it is probed with its own substrings where such a segment can stand: a segment i can
be moved by i at most seen from the left, and by what is left of the edits seen from the right. Index
and probes meet on a hash of all that. Keys of one line alone, nearly all, are dropped. Every other row carries 64 parity
bits of its line's character pairs; an edit changes four of them at most, so pairs that differ in more are dropped
inside the join, before they become rows. What is left is verified by Spark's banded edit distance, which only fills the cells
within EDITS of the diagonal (a bit-parallel one cannot be said in built-in functions).

Defined results: a null or blank text has no lines; rows that are equal in doc_id and text are one document and have equal
results, so neither empties the other; null doc_ids come last in the order; an empty table gives no rows; other columns pass
through ``dedup_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import common as C
from docloom.llm.graph import components
from docloom.llm.registry import query
from docloom.session import materialise
from docloom.sources.tables import load

EDITS = 2
MIN_CHARS = 40
#: What a row of a key is for.
PROBE, INDEX = 1, 2


def text_lines(text: Column) -> Column:
    """(place, line) of the lines that hold a word."""
    numbered = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x, i: F.struct(i.alias("place"), x.alias("line")))
    return F.filter(numbered, lambda x: x["line"].rlike(C.WORD))


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def occurrences(docs: DataFrame) -> DataFrame:
    """One row per line: doc_id, hash (of the text), place, line, a and b (two hashes of the line)."""
    rows = docs.select("doc_id", text_hash(F.col("text")).alias("hash"), F.explode(text_lines(F.col("text"))).alias("l"))
    return rows.select("doc_id", "hash", "l.place", "l.line", F.xxhash64("l.line").alias("a"), F.xxhash64(F.lit(1), "l.line").alias("b"))


def segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """First character (from 0) and size of segment i of a line; the later ones take the remainder."""
    size, longer = F.call_function("div", length, F.lit(parts)).cast("int"), length % parts
    extra = longer - F.lit(parts - i)
    return size * i + F.greatest(extra, F.lit(0)), size + (extra >= 0).cast("int")


def index_key(line: Column, length: Column, i: int, edits: int) -> Column:
    at, size = segment(length, i, edits + 1)
    return F.xxhash64(length, F.lit(i), F.substring(line, at + 1, size))


def probe_keys(line: Column, length: Column, edits: int) -> list[Column]:
    """Keys under which lines that are 0 to EDITS characters shorter may be indexed, but for those that the line has in the index itself."""
    keys = []
    for shorter in range(edits + 1):
        other = length - shorter
        for i in range(edits + 1):
            at, size = segment(other, i, edits + 1)
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1):
                if shorter == shift == 0:
                    continue  # index_key()
                # Inside the line wherever segments have a character; else a probe more, whose pairs are verified as all are.
                keys.append(F.xxhash64(other, F.lit(i), F.substring(line, at + shift + 1, size)))
    return keys


def pair_bits(line: Column) -> Column:
    """Parity, per hash value of 64, of the pairs of neighbouring characters."""
    def fold(chars: Column) -> Column:
        bit = F.transform(chars, lambda c, i: F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(c, F.get(chars, i + 1)), F.lit(64))))
        return F.aggregate(bit, F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))

    return C.bind(F.split(line, ""), fold)


def similar_lines(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """Edges (a, b) between ids of lines within so many edits. ``lines``: columns a (id), line; ids may repeat."""
    # The length is a column, so that it is counted once and not for each key.
    distinct = lines.groupBy("a").agg(F.first("line").alias("line")).withColumn("n", F.length("line"))
    length = F.col("n")
    # The lowest bit is set for probes, the next for index entries. A line probes its own index keys too: one row for both.
    keys = [F.shiftleft(index_key(F.col("line"), length, i, edits), 2).bitwiseOR(F.lit(PROBE | INDEX)) for i in range(edits + 1)]
    keys += [F.shiftleft(k, 2).bitwiseOR(F.lit(PROBE)) for k in probe_keys(F.col("line"), length, edits)]
    keys = distinct.select("a", F.explode(F.array(*keys)).alias("key")).filter(F.col("key").isNotNull())
    # Dealt by key once, for both uses: most keys are of one line alone and go no further.
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = keys.repartition(parts, F.shiftright("key", 2)).withColumn("pair", F.shiftright("key", 2))
    shared = keys.groupBy("pair").agg(F.min("a").alias("lo"), F.max("a").alias("hi"), F.bit_or("key").alias("uses"))
    both = F.lit(PROBE | INDEX).cast("long")
    shared = shared.filter((F.col("lo") != F.col("hi")) & (F.col("uses").bitwiseAND(both) == both)).select("pair")
    # Few keys are shared, and both sides are dealt alike: a hash table of those spares a sort of all.
    own = keys.join(shared.hint("shuffle_hash"), "pair", "left_semi").groupBy("a").agg(F.collect_list("key").alias("keys"))
    # One table of the lines that may have a partner, at most as many keys in each as a line has.
    some = materialise(own.join(distinct, "a").select("a", "line", "n", "keys", pair_bits(F.col("line")).alias("bits")), "line-keys")
    keys = some.select("a", "bits", "n", F.explode("keys").alias("key")).withColumn("pair", F.shiftright("key", 2))
    probes = keys.filter(F.col("key").bitwiseAND(F.lit(PROBE).cast("long")) != 0).select("pair", "a", "n", "bits")
    index = keys.filter(F.col("key").bitwiseAND(F.lit(INDEX).cast("long")) != 0).select(
        F.col("pair").alias("at"), F.col("a").alias("other"), F.col("n").alias("other_n"), F.col("bits").alias("other_bits"))
    near = F.bit_count(F.col("bits").bitwiseXOR(F.col("other_bits"))) <= 4 * edits
    # Lines of one length probe each other; one direction is enough.
    once = (F.col("n") > F.col("other_n")) | (F.col("a") < F.col("other"))
    found = probes.join(index, (F.col("pair") == F.col("at")) & (F.col("a") != F.col("other")) & once & near)
    found = found.select(F.least("a", "other").alias("a"), F.greatest("a", "other").alias("b")).distinct()
    texts = some.select("a", "line")
    left = found.join(texts, "a").withColumnRenamed("line", "left")
    both = left.join(texts.withColumnRenamed("a", "b"), "b")
    return both.filter(F.levenshtein("left", "line", edits) >= 0).select("a", "b")


def removed_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document with such lines: doc_id, hash, removed (places), n_near (removed lines that differ from the one that stays)."""
    found = occurrences(docs)
    long_lines = found.filter(F.length("line") >= min_chars).select("a", "line")
    roots = components(similar_lines(long_lines, edits))
    found = found.drop("line")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "place")
    lines = found.groupBy("a", "b").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
    lines = lines.join(roots.withColumnRenamed("node", "a"), "a", "left").filter((F.col("n") > 1) | F.col("root").isNotNull())
    lines = materialise(lines.select("a", "b", "first", "root"), "repeated-lines")
    heads = lines.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("first").alias("head"))
    lines = lines.join(heads, "root", "left").select(
        "a", "b", F.coalesce("head", "first").alias("head"), (F.coalesce("head", "first") != F.col("first")).alias("near"))
    gone = found.join(lines, ["a", "b"]).filter(
        ~(F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("hash") == F.col("head.hash")) & (F.col("place") == F.col("head.place"))))
    # A set: equal rows of the input name the same places.
    places = gone.groupBy("doc_id", "hash").agg(F.collect_set(F.struct("place", "near")).alias("found"))
    return places.select("doc_id", "hash", F.sort_array(F.transform("found", lambda x: x["place"])).alias("removed"),
                         F.size(F.filter("found", lambda x: x["near"])).cast("long").alias("n_near"))


def with_removed(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    gone = removed_lines(docs, edits, min_chars).select(
        F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"), F.col("removed").alias("__removed"))
    rows = docs.withColumn("__text_hash", text_hash(F.col("text")))
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left")
    return joined.withColumn("__removed", F.coalesce("__removed", F.array().cast("array<int>")))


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without the lines that go; blank lines stay."""
    rows = with_removed(docs, edits, min_chars)
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("__removed", i))
    return rows.withColumn("text", F.array_join(kept, "\n")).select(*docs.columns)


@query("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    narrow = docs.select("doc_id", text_hash(F.col("text")).alias("h"), F.size(text_lines(F.col("text"))).cast("long").alias("n_lines"))
    gone = removed_lines(docs).withColumnRenamed("doc_id", "id")
    rows = narrow.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hash")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return rows.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"),
                       F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), removed.alias("removed"))
