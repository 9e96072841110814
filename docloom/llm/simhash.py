"""SimHash near-duplicates by Golay-code fuzzy hashing (operator 7).

Fingerprint: 64 bits over the XXH64 of all three-word shingles (A-Z lower-cased, repeats
included); a bit is 1 if it is set in over half of them. Two fingerprints link at ``BITS`` (2) or
fewer differing bits; components of links are groups.

Candidates: the fingerprint is cut into three segments of 22, 21 and 21 bits. Of two differing
bits at most, some segment has none while the next one (in a circle) has one at most: if the
errors are 0, 1 and 1 any order will do, and if one segment has two, start behind it. So a key
is an exact segment with a fuzzy form of the next one. The fuzzy forms come from the perfect
binary Golay code of 23 bits: a segment is decoded as it is and with each of its bits flipped, which
gives one codeword index or six; segments that differ in one bit share one.

Fingerprints are made distinct before that, so copies cost nothing. Keys of up to ``BUCKET``
distinct fingerprints are verified bit by bit and give one edge per member. The fingerprints of larger ones are joined
exactly and without pairs: two of them link just if some 64-bit value is within one bit of both, so
all 65 such values of each are grouped and tied to the least fingerprint of the group.

Defined results: a null or wordless text has fingerprint zero and is linked as any other; fewer
than three words are one shingle; rows with a null doc_id are grouped, and a group of nothing else has a null
component_id; repeated rows get a row each; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.graph import components
from docloom.llm.registry import query
from docloom.session import materialise
from docloom.sources.tables import load

WORDS = 3
SEED = 42
BITS = 2
#: Distinct fingerprints of one key that are compared in a task.
BUCKET = 512
#: (first bit, width) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Fixed value: generator polynomial of the binary Golay code.
GENERATOR = 0b101011100011


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()  # on bytes, both only know ASCII
    if not words:
        return 0
    if len(words) < WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = memoryview(b" ".join(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - WORDS + 1].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    ends = ends[WORDS - 1:].tolist()
    for lo in range(0, len(starts), 1 << 16):
        h = np.array([digest(line[a:z], SEED) for a, z in zip(starts[lo:lo + (1 << 16)], ends[lo:lo + (1 << 16)])], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def fingerprint_column(text: Column) -> Column:
    return F.pandas_udf(fingerprints, "long")(F.coalesce(text, F.lit("")))


def syndromes(values: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit polynomials by the generator."""
    rest = values.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return rest


def correction_table() -> np.ndarray:
    """The error of weight three at most for each of the 2**11 syndromes; the code is perfect, so each has one."""
    errors = [0] + [1 << i for i in range(23)]
    errors += [1 << i | 1 << j for i in range(23) for j in range(i)]
    errors += [1 << i | 1 << j | 1 << k for i in range(23) for j in range(i) for k in range(j)]
    errors = np.array(errors, np.int64)
    table = np.zeros(1 << 11, np.int64)
    table[syndromes(errors)] = errors
    return table


def codewords(values: np.ndarray, width: int, table: np.ndarray) -> np.ndarray:
    """Per value (row) the indices of its nearby codewords: of itself and of each one-bit change."""
    near = values[:, None] ^ np.concatenate(([0], 1 << np.arange(width, dtype=np.int64)))
    return (near ^ table[syndromes(near)]) >> 11  # the code is systematic: the upper 12 bits name the word


def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: distinct fingerprints to (key, fingerprint) rows."""
    table = correction_table()
    for b in batches:
        for lo in range(0, b.num_rows, 1 << 15):
            fp = b.column(0).slice(lo, 1 << 15).to_numpy(zero_copy_only=False).astype(np.int64)
            parts = [(fp.view(np.uint64) >> np.uint64(at)).view(np.int64) & ((1 << width) - 1) for at, width in SEGMENTS]
            for i, exact in enumerate(parts):
                j = (i + 1) % len(SEGMENTS)
                words = np.sort(codewords(parts[j], SEGMENTS[j][1], table), axis=1)
                keys = (i << 36) | (exact[:, None] << 12) | words
                new = np.ones(words.shape, bool)
                new[:, 1:] = words[:, 1:] != words[:, :-1]
                yield pa.RecordBatch.from_arrays([pa.array(keys[new]), pa.array(np.repeat(fp, new.sum(axis=1)))], names=["key", "fp"])


def bucket_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: the fingerprints of each key to edges from each to the least of its component among them."""
    for b in batches:
        a, z = [], []
        for members in b.column(0):
            fp = members.values.to_numpy().astype(np.int64)
            linked = np.bitwise_count(fp[:, None] ^ fp) <= BITS
            root, last = fp, None
            while last is None or (root != last).any():
                last, root = root, np.where(linked, root, np.iinfo(np.int64).max).min(axis=1)
            tied = root != fp
            a.append(fp[tied])
            z.append(root[tied])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x or [np.empty(0, np.int64)])) for x in (a, z)], names=["a", "b"])


def neighbours(fp: Column) -> Column:
    """The 65 values within one bit."""
    return F.concat(F.array(fp), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: fp.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))


def edges(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) whose components are those of the links. ``distinct``: column fp."""
    keys = distinct.select("fp").mapInArrow(key_rows, "key long, fp long")
    counts = keys.groupBy("key").count().filter("count > 1")
    shared = materialise(keys.join(counts, "key"), "shared-keys")
    small = shared.filter(F.col("count") <= bucket).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    small = small.select("fps").mapInArrow(bucket_edges, "a long, b long")
    large = shared.filter(F.col("count") > bucket).select("fp").distinct()
    large = large.select("fp", F.explode(neighbours(F.col("fp"))).alias("value"))
    least = large.groupBy("value").agg(F.min("fp").alias("least"))
    large = large.join(least, "value").filter(F.col("fp") != F.col("least")).select(F.col("fp").alias("a"), F.col("least").alias("b"))
    return small.union(large).distinct()


def groups(marked: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint. ``marked``: columns doc_id, fp."""
    distinct = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = components(edges(distinct, bucket)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return materialise(rooted.join(named, "root").select("fp", "component_id", "root"), "fingerprint-groups")


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Per row: doc_id, fingerprint, component_id."""
    marked = materialise(docs.select("doc_id", fingerprint_column(F.col("text")).alias("fp")), "marked")
    return marked.join(groups(marked, bucket).drop("root"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The documents without near-duplicates: of a group the row with the least doc_id stays, then the least hash of the row."""
    rows = docs.withColumn("__fp", fingerprint_column(F.col("text")))
    tie = F.xxhash64(*[F.col(c) for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))])
    marked = materialise(rows.select("doc_id", F.col("__fp").alias("fp"), tie.alias("tie")), "marked")
    named = groups(marked, bucket)
    # The rows to keep, found on the narrow table: one struct per group.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "fp")).alias("first")
    kept = marked.join(named.select("fp", "root"), "fp").groupBy("root").agg(first)
    kept = kept.select(F.col("first.doc_id").alias("__id"), F.col("first.tie").alias("__tie"), F.col("first.fp").alias("__f"))
    rows = rows.withColumn("__t", tie)
    out = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__tie")) & (rows["__fp"] == F.col("__f")), "left_semi")
    # Rows that are equal in every column all match: one of them stays.
    return out.dropDuplicates(["__fp", "__t"]).select(*docs.columns)


@query("op7_simhash_groups")
def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"))
