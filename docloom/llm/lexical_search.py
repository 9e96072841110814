"""Ranked lexical search by presence masks (operator 13).

Each item (query) ranks all documents by an integer BM25-like score: the weights of its terms that a document holds, each
times a share that grows with the term's occurrences and shrinks with the document's length.

One pass over the texts leaves, per document, its length and the terms of any item that it holds with their counts; it also
counts documents, terms and document frequencies. A second pass takes that narrow table in blocks of ``BLOCK`` documents. Within a block
every term has a bitmap of the documents that hold it. An item's bitmaps are turned over into one mask of matched terms per document, and documents with
one mask form a group. A mask's maximum score is the sum of its terms' largest parts in the block. Masks are evaluated by descending maximum, until
it falls below the item's ``TOP``-th score so far, which a task carries from block to block: what is left cannot enter, and equal scores are still looked at, as a
lesser id would win. A task leaves ``TOP`` rows an item at most, and a window over these ranks them.

No row is formed per item and document. Items are taken in passes of about ``PASS_BYTES`` of terms, which bounds what is sent to the tasks; a larger
benchmark takes more passes.

Defined results: an item or document without a term (null, empty) ranks nothing and nowhere; repeated items (one id and text) are one,
items of one id with different texts rank on their own; repeated documents all rank, null ids last among equal scores; no rows for
empty tables; other columns are not read. Texts of any length are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.common import LOWER, UPPER, split_words
from docloom.llm.registry import query
from docloom.session import materialise
from docloom.sources.tables import load

TOP = 10
#: Documents of a block, items taken together within it, bytes of item terms in a pass over the documents.
BLOCK = 4096
ITEMS = 64
PASS_BYTES = 1 << 24

#: kind 0: a document's terms and counts; kind 1: a task's document frequencies.
POSTINGS = "kind int, doc_id long, n long, terms array<int>, counts array<int>"


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms) of the distinct items that have terms; ``terms`` sorted, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = [sorted(set(split_words(t or ""))) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    return rows.mapInArrow(run, "item_id long, terms array<binary>").filter(F.size("terms") > 0)


def postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """The documents' lengths and their counts of the numbered terms, and each task's document frequencies."""
    sent = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = sent.value, np.zeros(len(sent.value), np.int64)

        def out(kinds, ids, n, terms, counts) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), ids, pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                               pa.array(counts, pa.list_(pa.int32()))], names=["kind", "doc_id", "n", "terms", "counts"])

        for b in batches:
            n, terms, counts = [], [], []
            for text in b.column(1):
                found = split_words(text.as_py() or "")
                tf = [(number[w], c) for w, c in Counter(found).items() if w in number]
                n.append(len(found))
                terms.append([t for t, _ in tf])
                counts.append([c for _, c in tf])
            for t in terms:
                held[t] += 1
            yield out([0] * len(n), b.column(0), n, terms, counts)
        at = np.flatnonzero(held)
        yield out([1], pa.array([None], pa.int64()), [0], [at.tolist()], [held[at].tolist()])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, POSTINGS)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The best scores of one item so far: descending score, then ascending id, a null id last."""

    def __init__(self, size: int) -> None:
        self.size, self.rows = size, []

    def bound(self) -> int:
        """A score below this cannot enter."""
        return self.rows[-1][0] if len(self.rows) == self.size else 1

    def take(self, scores: np.ndarray, ids: list[int | None]) -> None:
        rows = self.rows + [(s, d) for s, d in zip(scores.tolist(), ids)]
        self.rows = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:self.size]


def group_masks(bitmaps: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bitmaps (term, packed documents) to the distinct masks (mask, term), the documents in order of their mask, and where each mask's begin.

    Documents that hold none of the terms are in no group.
    """
    some = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bitmaps, axis=0), count=n, bitorder="little"))
    if not len(some):
        return np.empty((0, len(bitmaps)), bool), some, np.empty(0, np.int64)
    held = np.unpackbits(bitmaps, axis=1, count=n, bitorder="little")[:, some]
    turned = np.packbits(held, axis=0, bitorder="little")
    wide = np.zeros((-len(turned) % 8 + len(turned), len(some)), np.uint8)
    wide[:len(turned)] = turned
    keys = np.ascontiguousarray(wide.T).view(np.uint64)
    order = np.lexsort(keys.T) if keys.shape[1] > 1 else np.argsort(keys[:, 0], kind="stable")
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    begin = np.flatnonzero(new)
    return held[:, order[begin]].T.astype(bool), some[order], begin


def rank_block(best: list[Best], items: list[np.ndarray], ids: list, n: np.ndarray, terms: np.ndarray, counts: np.ndarray, rows: np.ndarray,
               weights: np.ndarray, n_docs: int, n_terms: int) -> None:
    """Takes a block's documents into the items' best. ``rows``: the document, by its place in the block, of each (term, count)."""
    m = 10 + 90 * n * n_docs // n_terms
    scored = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * m[rows]))
    order = np.argsort(terms, kind="stable")
    terms, rows, scored = terms[order], rows[order], scored[order]
    for lo in range(0, len(items), ITEMS):
        some = items[lo:lo + ITEMS]
        wanted = np.unique(np.concatenate(some))
        first, end = np.searchsorted(terms, wanted), np.searchsorted(terms, wanted, "right")
        parts = np.zeros((len(wanted), len(ids)), np.int64)
        held = np.zeros((len(wanted), len(ids)), np.uint8)
        for k, (a, z) in enumerate(zip(first.tolist(), end.tolist())):
            parts[k, rows[a:z]] = scored[a:z]
            held[k, rows[a:z]] = 1
        bitmaps, largest = np.packbits(held, axis=1, bitorder="little"), parts.max(axis=1)
        for k, item in enumerate(some):
            at = np.searchsorted(wanted, item)
            at = at[end[at] > first[at]]
            if not len(at):
                continue
            top = best[lo + k]
            if largest[at].sum() < top.bound():
                continue
            masks, documents, begin = group_masks(bitmaps[at], len(ids))
            most = masks @ largest[at]
            stop = np.append(begin[1:], len(documents))
            by_most = np.argsort(-most, kind="stable")
            done = 0
            while done < len(by_most) and most[by_most[done]] >= top.bound():
                # A few masks at a time, more and more of them.
                now = by_most[done:2 * done + 8]
                now = now[most[now] >= top.bound()]
                some_docs = np.concatenate([documents[begin[g]:stop[g]] for g in now])
                scores = parts[np.ix_(at, some_docs)].sum(axis=0)
                enough = scores >= top.bound()
                top.take(scores[enough], [ids[d] for d in some_docs[enough]])
                done = 2 * done + 8


def best_rows(numbered: list[tuple[int, list[int]]], weights: np.ndarray, n_docs: int, n_terms: int, top: int, block: int):
    """Task body: postings to each item's best documents among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [np.array(terms, np.int64) for _, terms in numbered]
        best = [Best(top) for _ in items]
        for b in batches:
            for lo in range(0, b.num_rows, block):
                part = b.slice(lo, block)
                counts, terms = part.column(3), part.column(2)
                sizes = np.diff(terms.offsets.to_numpy())
                rank_block(best, items, part.column(0).to_pylist(), part.column(1).to_numpy(), terms.flatten().to_numpy().astype(np.int64),
                           counts.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(sizes)), sizes), weights, n_docs, n_terms)
        rows = [(k, s, d) for (k, _), x in zip(numbered, best) for s, d in x.rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["item", "score", "doc_id"])

    return run


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, pass_bytes: int = PASS_BYTES, block: int = BLOCK) -> DataFrame:
    """Each item's ``top`` best documents: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    indexed = item_terms(items).select("item_id", "terms", F.monotonically_increasing_id().alias("item"))
    indexed = materialise(indexed, "item-terms")
    size = F.aggregate("terms", F.lit(0), lambda a, t: a + F.length(t) + 8)
    passes = 1 + (indexed.agg(F.sum(size)).first()[0] or 0) // pass_bytes
    found = None
    for k in range(passes):
        rows = indexed.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == k).select("item", "terms").collect()
        numbers = {t: i for i, t in enumerate(sorted({t for r in rows for t in map(bytes, r["terms"])}))}
        table = materialise(postings(docs, numbers), "postings")
        n_docs, n_terms = table.filter("kind = 0 AND n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(numbers), np.int64)
        # One row a numbered term, which PASS_BYTES bounds.
        held = table.filter("kind = 1").select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms").agg(F.sum("t.counts").alias("df"))
        for r in held.collect():
            df[r["terms"]] = r["df"]
        weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
        numbered = [(r["item"], [numbers[bytes(t)] for t in r["terms"]]) for r in rows]
        body = best_rows(numbered, weights, n_docs, max(n_terms, 1), top, block)
        part = table.filter("kind = 0 AND n > 0").select("doc_id", "n", "terms", "counts").mapInArrow(body, "item long, score long, doc_id long")
        found = part if found is None else found.union(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return found.join(indexed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


ORACLE = rf"""WITH i AS (SELECT row_number() OVER () AS item, item_id,
    list_distinct(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item, item_id, unnest(terms) AS term FROM i),
d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS terms FROM documents),
s AS (SELECT count(*) AS n_docs, coalesce(sum(len(terms)), 0)::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
p AS (SELECT k, doc_id, n, term, count(*) AS tf FROM (SELECT k, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, s),
r AS (SELECT item, item_id, k, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY ALL),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM r WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 10"""


@query("op13_lexical_search", ORACLE)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
