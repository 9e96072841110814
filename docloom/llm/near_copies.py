"""One document of each set of near copies, by MinHash keys and exact similarity (pipeline stage).

Similarity: the five-word shingles that two texts share, over all that either has (sets, A-Z
lower-cased). Rows are taken by doc_id (nulls last), then by the hash of the row: one stays unless a row that stays has
a similarity of ``SHARED / OF`` (0.8) or more with it and is found as its candidate.

Candidates have one of ``BANDS`` keys in common, each the hash of ``ROWS`` minima over the shingles, and agree in ``LIKELY`` of all
minima or more (by one byte of each). At a similarity of 0.8 a pair has no common key with a chance of
(1 - 0.8**6)**24, 7 in 10,000, and agrees less with about 2 in 10,000; nearer pairs are missed more rarely. Texts with equal shingles are made one before that.

No pairs are formed among near copies. In a round the open texts of a key are taken in order, inside a task: one that is like none of the
key's leaders so far leads too, the others are held against the leaders they are like. What leads in all of its keys stays; by full shingles,
its near copies are dropped; the rest goes on. So texts that share keys but are not alike all settle in one round, and so does a group of near copies.
What is alike but not near (about 0.65 to 0.8) may take more rounds: after ``ROUNDS`` of them all such pairs that are left are verified
once, and the edges among near ones are resolved in order. A key with more than ``BUCKET`` open texts takes one leader a round, without
gathering them, until it has fewer.

Defined results: fewer than five words are one shingle; null and wordless texts are equal; rows equal in
every column leave one; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import materialise

WORDS = 5
SHARED, OF = 4, 5
BANDS, ROWS = 24, 6
#: Minima of two texts, of BANDS * ROWS, that agree at least if the texts can be near.
LIKELY = 98
#: Open texts of a key that are held against each other in a task; rounds before all pairs are verified.
BUCKET = 2048
ROUNDS = 6
#: Shingles that are hashed at a time.
SLICE = 1 << 16
# Odd multipliers, from a rule.
SPREAD = np.array([xxhash.xxh64_intdigest(bytes([m]), WORDS) | 1 for m in range(BANDS * ROWS)], np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of a text's distinct shingles, ascending."""
    words = (text or "").encode().lower().split()  # on bytes, both only know ASCII
    if not words:
        return np.empty(0, np.uint64)
    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:max(1, len(words) - WORDS + 1)]
    ends = ends[min(WORDS, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    found = np.empty(0, np.uint64)
    for lo in range(0, len(starts), SLICE):
        part = np.array([digest(line[a:z]) for a, z in zip(starts[lo:lo + SLICE].tolist(), ends[lo:lo + SLICE].tolist())], np.uint64)
        found = np.unique(np.concatenate((found, part)))
    return found


def print_of(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes())).view(np.int64))


def minima(found: np.ndarray) -> np.ndarray:
    least = np.full(len(SPREAD), np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(found), 4096):
        np.minimum(least, (SPREAD[:, None] * found[lo:lo + 4096]).min(axis=1), out=least)
    return least


def keys_of(least: np.ndarray) -> np.ndarray:
    data = memoryview(least.tobytes())
    step = 8 * ROWS
    return np.array([xxhash.xxh64_intdigest(data[k * step:(k + 1) * step], k) for k in range(BANDS)], np.uint64).view(np.int64)


def sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: doc_id, tie and text to doc_id, tie, fp (of the shingles), n of them, keys and a byte of each minimum."""
    for b in batches:
        fp, n, keys, sketches = [], [], [np.empty(0, np.int64)], []
        for text in b.column(2):
            found = shingles(text.as_py())
            least = minima(found)
            fp.append(print_of(found))
            n.append(len(found))
            keys.append(keys_of(least))
            sketches.append(least.astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([
            b.column(0), b.column(1), pa.array(fp, pa.int64()), pa.array(n, pa.int32()),
            pa.ListArray.from_arrays(pa.array(np.arange(len(fp) + 1, dtype=np.int32) * BANDS), pa.array(np.concatenate(keys))),
            pa.array(sketches, pa.binary())], names=["doc_id", "tie", "fp", "n", "keys", "sketch"])


def alike(n: np.ndarray, sketch: np.ndarray, others_n: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the others may be near: sizes too far apart cannot reach the similarity."""
    sizes = OF * np.minimum(n, others_n) >= SHARED * np.maximum(n, others_n)
    return sizes & ((sketch == others).sum(axis=-1) >= LIKELY)


def arrays_of(members: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row = members[i].values
    fp, n = row.field("fp").to_numpy(), row.field("n").to_numpy().astype(np.int64)
    return fp, n, np.frombuffer(b"".join(row.field("sketch").to_pylist()), np.uint8).reshape(len(fp), -1)


def leader_rows(every_pair: bool):
    """Task body: the open texts of a key, in order, to (a, b, leads): each one as b, with each earlier leader a that it is like, or without.

    ``every_pair``: with each earlier text instead.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, leads = [], [], []
            for i in range(batch.num_rows):
                fp, n, sketch = arrays_of(batch.column(0), i)
                leaders = np.zeros(0, np.int64)
                for k in range(len(fp)):
                    like = leaders[alike(n[k], sketch[k], n[leaders], sketch[leaders])]
                    if every_pair or not len(like):
                        leaders = np.append(leaders, k)
                    for f in fp[like].tolist() or [None]:
                        a.append(f)
                        b.append(int(fp[k]))
                        leads.append(f is None)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(leads, pa.bool_())], names=["a", "b", "leads"])

    return run


def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: texts of large keys beside the first of their key to (a, b, leads); all but the first do not lead."""
    for batch in batches:
        fp, n, first_fp, first_n = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 1, 3, 4))
        sketch, first = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(len(fp), BANDS * ROWS) for i in (2, 5))
        like = alike(n, sketch, first_n, first) & (fp != first_fp)
        yield pa.RecordBatch.from_arrays([pa.array(first_fp, pa.int64(), mask=~like), pa.array(fp), pa.array(fp == first_fp)], names=["a", "b", "leads"])


HELD = "a long, b long, leads boolean"


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: fp and text to fp and shingles."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t.as_py()).tobytes() for t in b.column(1)], pa.binary())],
                                         names=["fp", "shingles"])


def near_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: pairs with the shingles of both texts to those that are near."""
    for b in batches:
        is_near = []
        for x, y in zip(b.column(2), b.column(3)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            shared = len(np.intersect1d(x, y, assume_unique=True))
            is_near.append(OF * shared >= SHARED * (len(x) + len(y) - shared))
        yield b.select(["a", "b"]).filter(pa.array(is_near, pa.bool_()))


def near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of the pairs that are near copies."""
    first = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("x"))
    other = sets.select(F.col("fp").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(other, "b").join(first, "a").select("a", "b", "x", "y").mapInArrow(near_rows, "a long, b long")


def in_keys(left: DataFrame, every_pair: bool = False) -> DataFrame:
    """What the texts of each key are to each other: (a, b, leads)."""
    member = F.struct("none", "doc_id", "tie", "fp", "n", "sketch")
    sizes = left.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(member).alias("first"))
    large = left.join(sizes.filter(F.col("size") > BUCKET), "key")
    large = large.select("fp", "n", "sketch", F.col("first.fp").alias("f"), F.col("first.n").alias("m"), F.col("first.sketch").alias("s"))
    small = left.join(sizes.filter(F.col("size") <= BUCKET).select("key"), "key", "left_semi")
    small = small.groupBy("key").agg(F.sort_array(F.collect_list(member)).alias("members"))
    small = small.select(F.transform("members", lambda x: F.struct(x["fp"].alias("fp"), x["n"].alias("n"), x["sketch"].alias("sketch"))).alias("m"))
    return small.mapInArrow(leader_rows(every_pair), HELD).union(large.mapInArrow(first_rows, HELD))


def has_large_key(left: DataFrame) -> bool:
    return not left.groupBy("key").count().filter(F.col("count") > BUCKET).isEmpty()


def in_order(edges: DataFrame) -> list[DataFrame]:
    """What goes if the edges (a, b), a before b, are resolved in order: the b of every a that stays."""
    gone = []
    while not edges.isEmpty():
        firsts = edges.select("a").distinct().join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        gone.append(materialise(edges.join(firsts, "a", "left_semi").select(F.col("b").alias("fp")).distinct(), "near-copies"))
        for side in ("a", "b"):
            edges = edges.join(gone[-1].withColumnRenamed("fp", side), side, "left_anti")
        edges = materialise(edges, "near-edges")
    return gone


def copies(left: DataFrame, sets: DataFrame) -> list[DataFrame]:
    """Tables of the fp to drop. ``left``: rows (key, none, doc_id, tie, fp, n, sketch) of the texts with a common key."""
    dropped, rounds = [], 0
    while not left.isEmpty():
        rounds += 1
        if rounds > ROUNDS and not has_large_key(left):
            pairs = in_keys(left, every_pair=True).filter("a IS NOT NULL").select("a", "b").distinct()
            edges = near(materialise(pairs, "near-pairs"), sets)
            return dropped + in_order(materialise(edges, "near-edges"))
        held = materialise(in_keys(left), "held-keys")
        stays = held.groupBy(F.col("b").alias("fp")).agg(F.bool_and("leads").alias("stays")).filter("stays").select("fp")
        pairs = held.filter("a IS NOT NULL").select("a", "b").distinct().join(stays.withColumnRenamed("fp", "a"), "a", "left_semi")
        # Written, so that the few pairs of later rounds are sent to the sets and not the other way round.
        dropped.append(materialise(near(materialise(pairs, "near-pairs"), sets).select(F.col("b").alias("fp")).distinct(), "near-copies"))
        left = left.join(stays.union(dropped[-1]), "fp", "left_anti")
        # A key with one open text left binds it no more.
        left = left.join(left.groupBy("key").count().filter("count > 1").select("key"), "key", "left_semi")
        left = materialise(left.select("key", "none", "doc_id", "tie", "fp", "n", "sketch"), "open-keys")
    return dropped


def first_of_each(docs: DataFrame) -> DataFrame:
    """The documents that no document which stays is a near copy of."""
    tie = F.xxhash64(*[F.col(c) for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))])
    texts = docs.select("doc_id", tie.alias("tie"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    marked = texts.mapInArrow(sketch_rows, f"doc_id {kind}, tie long, fp long, n int, keys array<long>, sketch binary")
    me = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "fp", "n", "keys", "sketch")
    distinct = materialise(marked.groupBy("fp").agg(F.min(me).alias("me")).select("me.*"), "shingled")
    keys = distinct.select("fp", F.explode("keys").alias("key"))
    shared = keys.join(keys.groupBy("key").count().filter("count > 1").select("key"), "key")
    left = shared.join(distinct.drop("keys"), "fp").select("key", "none", "doc_id", "tie", "fp", "n", "sketch")
    left = materialise(left, "open-keys")
    open_ids = left.select("doc_id", "tie", "fp").distinct()
    sets = texts.alias("t").join(open_ids.alias("o"), F.col("t.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("t.tie") == F.col("o.tie")))
    sets = materialise(sets.select("o.fp", "t.text").mapInArrow(set_rows, "fp long, shingles binary").dropDuplicates(["fp"]), "shingle-sets")
    kept, dropped = distinct, copies(left, sets)
    if dropped:
        gone = dropped[0]
        for part in dropped[1:]:
            gone = gone.union(part)
        kept = distinct.join(gone, "fp", "left_anti")
    kept = kept.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"))
    rows = docs.withColumn("__t", tie)
    out = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__tie")), "left_semi")
    # Rows that are equal in every column all match: one of them stays.
    return out.dropDuplicates(["doc_id", "__t"]).select(*docs.columns)
