"""Exact-substring removal by sharded suffix arrays (operator 4).

Every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere is removed, judged on
the input as it is.

Shards. Every window of ``LENGTH`` bytes is named by its anchor, the least hash of the
``GRAM``-byte strings in it; equal windows have equal anchors. Consecutive windows with one anchor in
one place are a piece: at most LENGTH - GRAM + 1 windows, and the bytes under them. Pieces whose
anchor stands alone in the corpus are done; the others are made distinct by (anchor, digest), with their count, and
their bytes are dealt to shards by anchor, so that equal windows meet.

Per shard, a suffix array over all pieces is built by Larsson-Sadakane refinement (groups of equal prefix are
sorted by the rank of what follows, at twice the depth each round), and common prefixes follow in
Kasai's way, for all pieces side by side. A window repeats if its common prefix with a neighbour reaches
LENGTH or if its piece was counted twice.

An anchor with more than a shard's bytes is spread over shards. Each of them then hands on its
distinct windows of that anchor as a sorted run of digests, and the runs are merged, range by range of
the digest, by binary search of each window among the runs.

Defined results: a null text is empty; a text under LENGTH bytes keeps everything; repeated rows are
documents of their own, so each removes the other; a null doc_id is a document as any other; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.registry import query
from docloom.session import materialise
from docloom.sources.tables import load

LENGTH = 200
GRAM = 32
#: Bytes of pieces that one suffix array is built over, about.
SHARD_BYTES = 2 << 20
#: Distinct windows of spread anchors that one merge takes, about.
MERGE_ROWS = 1 << 20
#: Low bits of a window's minimum that hold the place; the anchor is what is above.
PLACE_BITS = 18

#: A random number per byte value, from a rule.
BYTES = np.array([xxhash.xxh64_intdigest(bytes([i]), GRAM) for i in range(256)], np.uint64)


def window_minima(data: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each window, the least gram hash in it with the gram's place (mod 2**PLACE_BITS) in the low bits."""
    h, done = BYTES[data], 1
    while done < gram:  # strings of twice the length from two neighbours; gram is a power of two
        h = h[:-done] * np.uint64(2 * done * 0x9E3779B97F4A7C15 + 1 & 0xFFFFFFFFFFFFFFFF) + h[done:]
        done *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    place = np.arange(len(h), dtype=np.uint64) & np.uint64((1 << PLACE_BITS) - 1)
    h = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | place
    grams, done = length - gram + 1, 1
    while 2 * done <= grams:
        h = np.minimum(h[:-done], h[done:])
        done *= 2
    return np.minimum(h[:len(h) - (grams - done)], h[grams - done:])


def pieces_of(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, digest, first window and number of windows of each piece."""
    if len(data) < length:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    least = window_minima(np.frombuffer(data, np.uint8), length, gram)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    count = np.diff(np.append(first, len(least)))
    view = memoryview(data)
    digest = xxhash.xxh64_intdigest
    digests = np.array([digest(view[a:a + n + length - 1]) for a, n in zip(first.tolist(), count.tolist())], np.uint64)
    return (least[first] >> np.uint64(PLACE_BITS)).astype(np.int64), digests.view(np.int64), first, count


def keyed(docs: DataFrame) -> DataFrame:
    """(id, hash, text): what names a text. Equal texts have equal results, so rows that share a name do no harm."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id"), F.xxhash64(text).alias("hash"),
                       F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


PLACES = "anchor long, digest long, id long, hash long, first long, windows int"


def place_rows(length: int, gram: int, anchors_only: bool):
    """Task body: texts to their pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: list[tuple] = []
            size = 0
            for doc, hashed, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                anchors, digests, first, count = pieces_of(text.as_py().encode(), length, gram)
                n = len(anchors)
                held.append((anchors, digests, np.full(n, doc), np.full(n, hashed), first, count.astype(np.int32)))
                size += n
                if size > 100_000:
                    yield batch(held, anchors_only)
                    held, size = [], 0
            yield batch(held, anchors_only)

    return run


def batch(held: list[tuple], anchors_only: bool) -> pa.RecordBatch:
    names = [f.split()[0] for f in PLACES.split(", ")]
    columns = [np.concatenate([h[i] for h in held] or [np.empty(0, np.int64)]) for i in range(1 if anchors_only else len(names))]
    if not anchors_only:
        columns[-1] = columns[-1].astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names[:len(columns)])


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes and rank of each, by Larsson-Sadakane refinement. The last symbol of every piece is unique."""
    n, base = len(codes), int(codes.max()) + 1
    key, h = codes.astype(np.int64), 1
    while base ** (2 * h) < 1 << 62:
        key = key * base ** h + np.concatenate((key[h:], np.zeros(min(h, n), np.int64)))
        h *= 2
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate(([True], key[1:] != key[:-1], [True]))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new[:-1], np.arange(n), 0))
    while True:
        active = np.flatnonzero(~(new[:-1] & new[1:]))
        if not len(active):
            return order, rank[:n]
        suffix = order[active]
        # Ranks stay with the groups' places, so sorting all open groups at once leaves each where it is.
        key = rank[suffix] * (n + 1) + rank[np.minimum(suffix + h, n)] + 1
        by = np.argsort(key)
        suffix, key = suffix[by], key[by]
        order[active] = suffix
        begins = np.concatenate(([True], key[1:] != key[:-1]))
        new[active] = begins
        rank[suffix] = active[np.maximum.accumulate(np.where(begins, np.arange(len(active)), 0))]
        h *= 2


def repeated_windows(pieces: list[bytes], length: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each piece, which windows occur twice among the pieces; the order of all suffixes; their common prefixes, 0 where under a window."""
    sizes = np.array([len(p) for p in pieces])
    starts = np.cumsum(sizes + 1) - sizes - 1
    codes = np.empty(int((sizes + 1).sum()), np.int64)
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    codes[:] = text
    codes += len(pieces)
    codes[starts + sizes] = np.arange(len(pieces))  # each piece ends in a symbol of its own
    order, rank = suffix_array(codes)
    common = np.zeros(len(codes) + 1, np.int64)
    # Kasai: the common prefix with the suffix before shrinks by one at most from a place to the next.
    live = np.arange(len(pieces))
    h = np.zeros(len(pieces), np.int64)
    for j in range(int((sizes - length + 1).max())):
        live = live[sizes[live] - length >= j]
        at = starts[live] + j
        where = rank[at]
        before = order[where - 1]
        got = np.maximum(h[live] - 1, 0)
        got[where == 0] = 0
        going = np.flatnonzero(where > 0)
        while len(going):
            going = going[codes[at[going] + got[going]] == codes[before[going] + got[going]]]
            got[going] += 1
        h[live] = got
        common[where] = got
    common[common < length] = 0
    twice = (common[:-1] > 0) | (common[1:] > 0)
    return [twice[rank[a:a + n - length + 1]] for a, n in zip(starts, sizes)], order, common


RUNS = "anchor long, digest long, froms array<int>, tos array<int>, windows array<binary>, window_at array<int>"


def runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last of each run of true flags."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()


def shard_rows(length: int):
    """Group body: the pieces of a shard to the runs of repeated windows in each.

    Of spread anchors also the windows that did not repeat here, and one of each that did, go on as digests.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["anchor", "digest"])
        pieces = group["piece"].tolist()
        flags, order, common = repeated_windows(pieces, length)
        out = []
        spread = group["spread"].to_numpy()
        for anchor, digest, copies, wide, piece, flag in zip(group["anchor"], group["digest"], group["copies"], spread, pieces, flags):
            windows, window_at = [], []
            if wide:
                window_at = list(range(len(flag)))
                windows = [xxhash.xxh128_digest(piece[i:i + length]) for i in window_at]
            froms, tos = runs(flag | (copies > 1))
            out.append((anchor, digest, froms, tos, windows, window_at))
        return pd.DataFrame(out, columns=["anchor", "digest", "froms", "tos", "windows", "window_at"])

    return run


def merge_runs(group: pd.DataFrame) -> pd.DataFrame:
    """Group body: windows of spread anchors in one range of the digest; those that another piece or place has too."""
    keys = np.array([x for x in group["window"]], dtype="V16").view(">u8").reshape(-1, 2)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    run = keys[order, 0]
    # Binary search of each window among the sorted runs, then of its second half among those that share the first.
    lo, hi = np.searchsorted(run, keys[:, 0], "left"), np.searchsorted(run, keys[:, 0], "right")
    second = keys[order, 1]
    twice = np.fromiter((z - a > 1 and int(np.searchsorted(second[a:z], k, "right") - np.searchsorted(second[a:z], k, "left")) > 1
                         for a, z, k in zip(lo, hi, keys[:, 1])), bool, len(keys))
    return group.loc[twice, ["anchor", "digest", "at"]]


def piece_rows(length: int):
    """Task body: texts and the pieces asked of them to the pieces' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            found: dict[tuple, tuple] = {}
            for packed, wanted in zip(b.column(0), b.column(1)):
                data = unpack.decompress(packed.as_py())
                for w in wanted.as_py():
                    found[w["anchor"], w["digest"]] = (w["shard"], w["spread"], w["copies"], data[w["first"]:w["first"] + w["windows"] + length - 1])
            rows = list(found.values())
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in found], pa.int64()), pa.array([k[1] for k in found], pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary()),
            ], names=["anchor", "digest", "shard", "spread", "copies", "piece"])

    return run


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: texts compressed for the shuffle."""
    pack = zstandard.ZstdCompressor(level=3)
    for b in batches:
        data = pa.array([pack.compress(t.as_py().encode()) for t in b.column(3)], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), data], names=["id", "hash", "doc_id", "packed"])


PACKED = "id long, hash long, doc_id long, packed binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<first: long, last: long>>"


def result_rows(length: int):
    """Task body: texts and their repeated windows to what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            found = b.column(2)
            of_doc = found.offsets.to_numpy()
            pieces = found.values
            ends = []
            for name, behind in (("froms", 0), ("tos", length)):
                part = pieces.field(name)
                of_piece = part.offsets.to_numpy()
                at = part.values.to_numpy() + np.repeat(pieces.field("first").to_numpy(), np.diff(of_piece)) + behind
                ends.append((at, of_piece[of_doc]))
            for i, (doc_id, text) in enumerate(zip(b.column(0), b.column(1))):
                data = np.frombuffer(unpack.decompress(text.as_py()), np.uint8)
                edge = np.zeros(len(data) + 1, np.int32)
                for (at, of), step in zip(ends, (1, -1)):  # what repeats within a shard and across shards comes twice
                    np.add.at(edge, at[of[i]:of[i + 1]], step)
                gone = np.cumsum(edge[:-1]) > 0
                first, last = runs(gone)
                kept = data[~gone] if first else data
                out.append((doc_id.as_py(), len(data), len(data) - len(kept), len(first), hashlib.sha256(kept.tobytes()).hexdigest(),
                            [{"first": x, "last": y} for x, y in zip(first, last)]))
            spans = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), spans]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def repeats(docs: DataFrame, length: int, gram: int, shard_bytes: int, merge_rows: int) -> DataFrame:
    """(id, hash, first, froms, tos): runs of repeated windows, per piece of a text."""
    texts = keyed(docs).select("id", "hash", "text")
    # Anchors are counted first; only places of anchors that occur twice are kept, of all texts.
    counts = texts.mapInArrow(place_rows(length, gram, True), "anchor long").groupBy("anchor").count().filter("count > 1")
    counts = materialise(counts.select("anchor"), "repeated-anchors")  # as a table it lets the join split a hot anchor
    places = texts.mapInArrow(place_rows(length, gram, False), PLACES)
    places = materialise(places.join(counts, "anchor", "left_semi"), "places")
    one = F.min(F.struct("id", "hash", "first", "windows")).alias("one")
    distinct = places.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("copies"), one)
    distinct = materialise(distinct.select("anchor", "digest", "copies", "one.*"), "pieces")
    size = F.col("windows").cast("long") + (length - 1)
    total = distinct.agg(F.sum(size)).first()[0] or 0
    shards = total // shard_bytes + 1
    wide = distinct.groupBy("anchor").agg(F.sum(size).alias("bytes")).filter(F.col("bytes") > shard_bytes)
    wide = materialise(wide, "wide-anchors")
    named = distinct.join(wide, "anchor", "left").withColumn("spread", F.col("bytes").isNotNull())
    within = F.when(F.col("spread"), F.pmod(F.xxhash64("digest"), F.expr(f"bytes div {shard_bytes} + 1"))).otherwise(F.lit(0).cast("long"))
    named = named.withColumn("shard", F.pmod(F.xxhash64("anchor", within), F.lit(shards)))
    wanted = named.groupBy("id", "hash").agg(F.collect_list(
        F.struct("anchor", "digest", "shard", "spread", "copies", "first", "windows")).alias("wanted"))
    sent = keyed(docs).mapInArrow(packed, PACKED).join(wanted, ["id", "hash"])
    pieces = sent.select("packed", "wanted").mapInArrow(
        piece_rows(length), "anchor long, digest long, shard long, spread boolean, copies long, piece binary")
    found = pieces.groupBy("shard").applyInPandas(shard_rows(length), RUNS)
    has_wide = wide.limit(1).count() > 0
    found = materialise(found if has_wide else found.filter(F.size("froms") > 0), "runs")
    within_shard = found.filter(F.size("froms") > 0).select("anchor", "digest", "froms", "tos")
    if has_wide:
        windows = found.select("anchor", "digest", F.explode(F.arrays_zip("windows", "window_at")).alias("w"))
        windows = windows.select("anchor", "digest", F.col("w.windows").alias("window"), F.col("w.window_at").alias("at"))
        ranges = windows.count() // merge_rows + 1
        merged = windows.groupBy(F.pmod(F.xxhash64("window"), F.lit(ranges)).alias("range")).applyInPandas(
            merge_runs, "anchor long, digest long, at int")
        crossing = merged.groupBy("anchor", "digest").agg(F.sort_array(F.collect_list("at")).alias("froms"))
        within_shard = within_shard.union(crossing.select("anchor", "digest", "froms", F.col("froms").alias("tos")))
    return places.join(within_shard, ["anchor", "digest"]).select("id", "hash", "first", "froms", "tos")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
                   merge_rows: int = MERGE_ROWS) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (first and last byte of each)."""
    found = repeats(docs, length, gram, shard_bytes, merge_rows)
    found = found.groupBy("id", "hash").agg(F.collect_set(F.struct("first", "froms", "tos")).alias("found"))
    rows = keyed(docs).mapInArrow(packed, PACKED).join(found, ["id", "hash"], "left")
    return rows.select("doc_id", "packed", "found").mapInArrow(result_rows(length), RESULT)


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(load(spark, sf_dir, "documents")).drop("spans")
