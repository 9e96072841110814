"""Benchmark decontamination by size-partitioned MinHash containment search (operator 8).

Items and documents are sets of word shingles (five words; an item of fewer is one shingle of its
own width). Documents are partitioned by size: class p holds those of up to 2**p distinct
shingles, and sketches them by one-permutation MinHash over 2**(p + 1) bins, so that a short item's shingle is
the minimum of its bin in a long document as easily as in a short one. An item is sketched once for each class.
A document and an item that agree in a bin are a candidate: sketches alone are joined for it. Candidates are verified by exact
containment: the shingles themselves, all of them, are compared, and the pair is a hit if the
document holds at least ``CONTAINMENT`` of the item's. An item with fewer than ``SMALL``
shingles is looked up on every one of them; of the others a contained item is
missed with a chance below 0.4 ** 13.

Document shingles that no item has are dropped before any shuffle by a Bloom filter of
``FILTER_BITS`` bits; a larger benchmark only lets more rows through.

Defined results: a null or wordless text contains nothing, such an item is in nothing; one row per
(doc_id, item_id) with the largest containment, so repeated rows count once; null ids are ids as any other; no rows for empty tables; other columns
are not read. Texts of any length are shingled whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import split_words
from docloom.llm.registry import query
from docloom.session import materialise
from docloom.sources.tables import load

WIDTH = 5
CONTAINMENT = 0.8
SMALL = 16
CLASSES = 48
FILTER_BITS = 1 << 23

#: Odd multipliers by word position, from a rule.
STEPS = np.array([xxhash.xxh64_intdigest(bytes([k])) | 1 for k in range(WIDTH)], dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(word_hashes: np.ndarray, width: int) -> np.ndarray:
    n = len(word_hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += word_hashes[k:k + n] * STEPS[k]
    total ^= total >> np.uint64(32)
    total *= MIX
    return total ^ (total >> np.uint64(29))


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def size_class(n: int) -> int:
    """The least p with n <= 2**p."""
    return max(n - 1, 0).bit_length()


def is_least(ordered: np.ndarray, p: int) -> np.ndarray:
    """Which of the ascending distinct hashes are the minimum of their bin among 2**(p + 1)."""
    bins = ordered >> np.uint64(63 - p)
    out = np.ones(len(ordered), bool)
    out[1:] = bins[1:] != bins[:-1]
    return out


def filter_slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(7)) & np.uint64(FILTER_BITS - 1)


def signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


ITEM_ROWS = "item_id long, item_key binary, n_shingles long, width int, hash long, shingle binary, classes long, slot long"


def item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: items to their distinct shingles; bit p of classes says whether it is in the sketch for class p."""
    for b in batches:
        for item_id, text in zip(b.column(0), b.column(1)):
            words = split_words(text.as_py() or "")
            if not words:
                continue
            width = min(WIDTH, len(words))
            h, first = np.unique(shingle_hashes(hashes_of(words), width), return_index=True)
            n = len(h)
            classes = np.zeros(n, np.int64)
            for p in range(CLASSES):
                classes |= (np.ones(n, bool) if n < SMALL else is_least(h, p)).astype(np.int64) << p
            key = hashlib.md5(b" ".join(words)).digest()
            yield pa.RecordBatch.from_arrays([
                pa.array([item_id.as_py()] * n, pa.int64()), pa.array([key] * n, pa.binary()), pa.array([n] * n, pa.int64()),
                pa.array([width] * n, pa.int32()), signed(h), pa.array([b" ".join(words[i:i + width]) for i in first], pa.binary()),
                pa.array(classes), pa.array(filter_slot(h).astype(np.int64)),
            ], names=["item_id", "item_key", "n_shingles", "width", "hash", "shingle", "classes", "slot"])


DOC_ROWS = "doc_id long, doc_key binary, class int, least boolean, width int, hash long, shingle binary"


def doc_rows(widths: list[int], bloom: np.ndarray):
    """Task body: documents to those distinct shingles that pass the filter, with what is in the sketch marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                text = text.as_py() or ""
                words = split_words(text)
                hashes = hashes_of(words)
                for width in widths:
                    h, first = np.unique(shingle_hashes(hashes, width), return_index=True)
                    slot = filter_slot(h)
                    passed = np.flatnonzero(bloom[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                    if not len(passed):
                        continue
                    p, n = size_class(len(h)), len(passed)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc_id.as_py()] * n, pa.int64()), pa.array([hashlib.md5(text.encode()).digest()] * n, pa.binary()),
                        pa.array([p] * n, pa.int32()), pa.array(is_least(h, p)[passed]), pa.array([width] * n, pa.int32()),
                        signed(h[passed]), pa.array([b" ".join(words[i:i + width]) for i in first[passed]], pa.binary()),
                    ], names=["doc_id", "doc_key", "class", "least", "width", "hash", "shingle"])

    return run


def contained_items(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """Hits: doc_id, doc_key (MD5 of the text), item_id, n_shingles, n_shared, containment."""
    index = materialise(items.select(F.col("item_id").cast("long"), "text").mapInArrow(item_rows, ITEM_ROWS).distinct(), "items")
    widths = sorted(r["width"] for r in index.select("width").distinct().collect())  # at most WIDTH
    # The filter, byte by byte: at most FILTER_BITS / 8 rows, whatever the size of the benchmark.
    bits = index.groupBy(F.expr("slot div 8").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(slot % 8 AS int))")).alias("bits")).toPandas()
    bloom = np.zeros(FILTER_BITS // 8, np.uint8)
    bloom[bits["at"].to_numpy(np.int64)] = bits["bits"].to_numpy(np.uint8)
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(doc_rows(widths, bloom), DOC_ROWS)
    found = materialise(found, "leak-shingles")
    # Copies of a text are searched once.
    key = ["width", "hash", "shingle"]
    texts = found.select("doc_key", "class", "least", *key).distinct()
    small = F.col("n_shingles") < SMALL
    in_sketch = F.expr("shiftright(classes, class)").bitwiseAND(F.lit(1)) == 1
    terms = index.select("item_key", "n_shingles", "classes", *key).distinct()
    by_sketch = texts.filter("least").join(terms.filter(~small), key).filter(in_sketch)
    by_shingle = texts.join(terms.filter(small), key)
    candidates = by_sketch.select("doc_key", "item_key").union(by_shingle.select("doc_key", "item_key")).distinct()
    candidates = materialise(candidates, "leak-candidates")
    # Verified by all shingles of both.
    shared = candidates.join(texts.select("doc_key", *key), "doc_key").join(terms.select("item_key", *key), ["item_key", *key], "left_semi")
    shared = shared.groupBy("doc_key", "item_key").agg(F.count(F.lit(1)).alias("n_shared"))
    named = shared.join(index.select("item_key", "item_id", "n_shingles").distinct(), "item_key")
    named = named.withColumn("containment", F.col("n_shared") / F.col("n_shingles")).filter(F.col("containment") >= containment)
    return named.join(found.select("doc_id", "doc_key").distinct(), "doc_key").select(
        "doc_id", "doc_key", "item_id", "n_shingles", "n_shared", "containment")


def decontaminate(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """The documents that hold no item."""
    dirty = contained_items(docs, items, containment).select(F.col("doc_id").alias("__id"), F.col("doc_key").alias("__key")).distinct()
    same = (F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
            & (F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))) == F.col("__key")))
    return docs.join(dirty, same, "left_anti")


def words_sql(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


ORACLE = f"""WITH i AS (SELECT item_id, w, least(5, len(w)) AS k FROM (SELECT item_id, {words_sql('text')} AS w FROM benchmark) WHERE len(w) > 0),
si AS (SELECT DISTINCT item_id, k, array_to_string(w[j:j + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS j FROM i)),
n AS (SELECT item_id, count(*) AS n_shingles FROM si GROUP BY item_id),
d AS (SELECT doc_id, {words_sql('text')} AS w FROM documents),
sd AS (SELECT DISTINCT doc_id, k, array_to_string(w[j:j + k - 1], ' ') AS s
  FROM (SELECT d.*, k, unnest(range(1, len(w) - k + 2)) AS j FROM d, (SELECT DISTINCT k FROM i))),
p AS (SELECT doc_id, item_id, count(*) AS n_shared FROM sd JOIN si USING (k, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment FROM p JOIN n USING (item_id)
WHERE n_shared / n_shingles >= 0.8"""


@query("op8_benchmark_leaks", ORACLE)
def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = contained_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    best = F.max(F.struct("containment", "n_shingles", "n_shared")).alias("best")
    return hits.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.n_shingles", "best.n_shared", "best.containment")
