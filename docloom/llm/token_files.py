"""Token ids as directly addressable codes (operator 5).

An id is cut into chunks of ``CHUNK_BITS`` bits, lowest first. Level k holds the k-th chunk of
every id that has one, in id order, with one continuation bit per entry that says whether the id
goes on at the next level, and a rank directory that counts those bits up to every
``RANK_STEP``-th entry. The entry of an id at the next level is the rank of its bit, so any id is
read by one byte per level: no block is decoded.

File format: a Parquet table, one row per block of at most ``BLOCK_IDS`` ids, with columns
part, block, first (ids of the part before the block), n, the documents that have ids in the block
(number in the part, doc_id, how many ids), and ``payload``, the codes:

    uint32 n_levels, then per level: uint32 entries, uint8[entries] chunks,
    uint8[ceil(entries / 8)] continuation bits (first entry highest), uint32[...] ranks

all little-endian. Spark's writer commits the files, so a lost task leaves none behind.

Defined results: a null text is an empty one and has the end id alone; an empty table gives no
rows; rows with a null doc_id come first; rows that share a doc_id are ordered by a hash of their text and
keep a row each; other columns are not read. A document may be of any length: it goes
over as many blocks as it needs.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.registry import query
from docloom.session import shared_dir
from docloom.sources.tables import load

CHUNK_BITS = 8
RANK_STEP = 512
BLOCK_IDS = 1 << 18
END_ID = 2
#: Pieces in the memo of a Python worker.
MEMO_PIECES = 1_000_000
#: Pieces that the tokenizer gets at a time; its results are large.
BATCH = 8192
#: Bytes of text encoded at a time.
SLICE_BYTES = 8 << 20

#: A space between two characters that are not white space: the tokenizer's pattern always
#: ends a piece there and starts the next one with the space, so both sides encode alone.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Texts with a space that is not of that kind. White space as Python's \s has it, spelled for RE2.
WHITE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
BESIDE_SPACE = f"{WHITE} | {WHITE}|^ | $"

BLOCKS = ("part int, block int, first long, n int, doc_no array<long>, doc_id array<long>, "
          "doc_n array<int>, payload binary")


def encode_levels(ids: np.ndarray) -> bytes:
    rest, out = ids.astype(np.uint32), []
    while True:
        more = rest >> CHUNK_BITS
        bits = more > 0
        ranks = np.concatenate(([0], np.cumsum(np.add.reduceat(bits, np.arange(0, len(bits), RANK_STEP), dtype=np.uint32)))
                               if len(bits) else [0]).astype("<u4")
        out.append(np.uint32(len(rest)).tobytes() + (rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8).tobytes()
                   + np.packbits(bits).tobytes() + ranks.tobytes())
        if not bits.any():
            return np.uint32(len(out)).tobytes() + b"".join(out)
        rest = more[bits]


class Codes:
    """Reader of one payload."""

    def __init__(self, payload: bytes):
        self.levels, at = [], 4
        for _ in range(int(np.frombuffer(payload, "<u4", 1)[0])):
            n = int(np.frombuffer(payload, "<u4", 1, at)[0])
            chunks = np.frombuffer(payload, np.uint8, n, at + 4)
            bits = np.frombuffer(payload, np.uint8, -(-n // 8), at + 4 + n)
            ranks = np.frombuffer(payload, "<u4", -(-n // RANK_STEP) + 1, at + 4 + n + len(bits))
            self.levels.append((chunks, bits, ranks))
            at += 4 + n + len(bits) + 4 * len(ranks)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """The id at i, from one entry per level."""
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK_BITS * k)
            if not bits[i >> 3] >> (7 - (i & 7)) & 1:
                return value
            step = i // RANK_STEP
            window = np.unpackbits(bits[step * RANK_STEP // 8:(i >> 3) + 1])[: i - step * RANK_STEP]
            i = int(ranks[step]) + int(window.sum())
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level from the last."""
        above = None
        for chunks, bits, _ in reversed(self.levels):
            value = chunks.astype(np.uint32)
            if above is not None:
                value[np.unpackbits(bits, count=len(chunks)).astype(bool)] |= above << CHUNK_BITS
            above = value
        return above


class Encoder:
    """Whole texts to ids with the tokenizers library; a piece met again comes from a memo.

    Texts are cut at single spaces by Arrow, the pieces of a slice are made distinct and looked up there too, so Python objects
    are built for new pieces alone. The memo (pieces, and where their ids are in a pool) lives as long as the Python worker; when it
    would hold more than ``MEMO_PIECES``, only the pieces of the slice stay.
    """

    shared: dict[tuple[str, int], "Encoder"] = {}

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.keys = pa.array([], pa.string())
        self.starts, self.lengths = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.array([end_id], "<u4")  # the end id is the first one

    @classmethod
    def of(cls, path: str, end_id: int = END_ID) -> "Encoder":
        if (path, end_id) not in cls.shared:
            cls.shared[path, end_id] = cls(path, end_id)
        return cls.shared[path, end_id]

    def add(self, pieces: pa.Array) -> None:
        """Encodes pieces that are not in the memo."""
        texts = pieces.to_pylist()
        found = []
        for lo in range(0, len(texts), BATCH):
            some = [e.ids for e in self.tokenizer.encode_batch_fast(texts[lo:lo + BATCH], add_special_tokens=False)]
            sizes = np.fromiter(map(len, some), np.int64, len(some))
            found.append((np.fromiter(itertools.chain.from_iterable(some), "<u4", int(sizes.sum())), sizes))
        ids, lengths = (np.concatenate(x) for x in zip(*found))
        self.keys = pa.concat_arrays([self.keys, pieces])
        self.starts = np.concatenate((self.starts, len(self.pool) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.pool = np.concatenate((self.pool, ids))

    def keep(self, places: np.ndarray) -> np.ndarray:
        """Forgets all pieces but those at these places, and returns where they are now."""
        some, now = np.unique(places, return_inverse=True)
        lengths = self.lengths[some]
        ids = self.pool[spans(self.starts[some], lengths)]
        self.keys, self.lengths, self.starts = self.keys.take(pa.array(some)), lengths, 1 + np.cumsum(lengths) - lengths
        self.pool = np.concatenate((self.pool[:1], ids))
        return now

    def look_up(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each piece are in the pool, and how many."""
        asked = pieces.dictionary_encode()
        # The memo is looked up in what is asked for: the smaller side is hashed.
        found = pc.fill_null(pc.index_in(self.keys, value_set=asked.dictionary), -1).to_numpy(zero_copy_only=False)
        held = np.flatnonzero(found >= 0)
        at = np.full(len(asked.dictionary), -1, np.int64)
        at[found[held]] = held
        new = at < 0
        if new.any():
            fresh = asked.dictionary.filter(pa.array(new))
            if len(self.keys) + len(fresh) > MEMO_PIECES:
                at[~new] = self.keep(at[~new])
            at[new] = len(self.keys) + np.arange(len(fresh))
            self.add(fresh)
        at = at[asked.indices.to_numpy()]
        return self.starts[at], self.lengths[at]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the end id behind it, and how many each has."""
        texts = pc.fill_null(texts, "")
        other = pc.match_substring_regex(texts, BESIDE_SPACE).to_numpy(zero_copy_only=False).astype(bool)
        lists = pc.split_pattern(texts.filter(pa.array(~other)), " ")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        found = lists.flatten().dictionary_encode()
        distinct, at = found.dictionary, found.indices.to_numpy().astype(np.int64)
        # The first piece of a text has no space before it.
        firsts = np.cumsum(sizes) - sizes
        heads = distinct.take(pa.array(at[firsts]))
        at[firsts] = len(distinct) + np.arange(len(firsts))
        cut = [CUT.split(texts[int(i)].as_py()) for i in np.flatnonzero(other)]
        odd = [piece for first, *rest in cut for piece in (first, *(" " + x for x in rest))]
        asked = pa.concat_arrays([pc.binary_join_element_wise(" ", distinct, ""), heads, pa.array(odd, pa.string())])
        starts, lengths = self.look_up(asked)
        # The pieces of all texts in a row, with the end behind each.
        pieces = np.empty(len(texts), np.int64)
        pieces[~other], pieces[other] = sizes, [len(c) for c in cut]
        ends = np.cumsum(pieces + 1) - 1
        order = np.full(int(ends[-1]) + 1, len(asked), np.int64)
        from_odd = np.repeat(other, pieces + 1)
        ordinary = np.ones(len(order), bool)
        ordinary[ends] = False
        order[ordinary & ~from_odd] = at
        order[ordinary & from_odd] = len(asked) - len(odd) + np.arange(len(odd))
        starts, lengths = np.append(starts, 0)[order], np.append(lengths, 1)[order]
        return self.pool.take(spans(starts, lengths)), np.add.reduceat(lengths, ends - pieces)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all spans, one behind the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 1 << 31 and (not total or starts.max() < 1 << 31) else np.int64
    out = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``SLICE_BYTES`` of text (column 1), one at least."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < b.num_rows:
            before = size[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(size, before + SLICE_BYTES, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def block_rows(path: str, end_id: int):
    """Task body: the part's documents, in their order, to blocks of codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = Encoder.of(path, end_id)
        schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n", pa.int32()),
                            ("doc_no", pa.list_(pa.int64())), ("doc_id", pa.list_(pa.int64())),
                            ("doc_n", pa.list_(pa.int32())), ("payload", pa.binary())])
        held, size, docs, state = [], 0, [], {"block": 0, "first": 0}

        def flush():
            nonlocal held, size, docs
            ids = np.concatenate(held)
            row = [[part], [state["block"]], [state["first"]], [len(ids)], [[d[0] for d in docs]], [[d[1] for d in docs]],
                   [[d[2] for d in docs]], [encode_levels(ids)]]
            state["block"] += 1
            state["first"] += len(ids)
            held, size, docs = [], 0, []
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, schema.types)], schema=schema)

        number = 0
        for some in slices(batches):
            ids, counts = encoder.encode(some.column(1))
            pa.default_memory_pool().release_unused()
            at = 0
            for doc_id, count in zip(some.column(0).to_pylist(), counts.tolist()):
                last = at + count
                while at < last:
                    take = min(last - at, BLOCK_IDS - size)
                    held.append(ids[at:at + take])
                    docs.append((number, doc_id, take))
                    size, at = size + take, at + take
                    if size == BLOCK_IDS:
                        yield flush()
                number += 1
        if size:
            yield flush()

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes the ids of all documents, by ascending doc_id, and returns the blocks as read back."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    rows.mapInArrow(block_rows(tokenizer, end_id), BLOCKS).write.parquet(folder)
    return spark.read.schema(BLOCKS).parquet(folder)


def crc_times(matrix: list[int], vector: int) -> int:
    total, i = 0, 0
    while vector:
        if vector & 1:
            total ^= matrix[i]
        vector >>= 1
        i += 1
    return total


def crc_join(a: int, b: int, length: int) -> int:
    """CRC-32 of two byte strings in a row, from the CRC of each and the second one's length."""
    step = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    for _ in range(3):
        step = [crc_times(step, x) for x in step]
    while length:
        if length & 1:
            a = crc_times(step, a)
        step = [crc_times(step, x) for x in step]
        length >>= 1
    return a ^ b


PIECES = "part int, doc_no long, doc_id long, block int, local long, n long, crc long"


def piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: blocks to one row per document and block."""
    for b in batches:
        for row in b.to_pylist():
            ids = Codes(row["payload"]).all().astype("<u4")
            ends = np.cumsum(row["doc_n"])
            starts = ends - row["doc_n"]
            n = len(ends)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["part"]] * n, pa.int32()), pa.array(row["doc_no"], pa.int64()),
                pa.array(row["doc_id"], pa.int64()), pa.array([row["block"]] * n, pa.int32()),
                pa.array(row["first"] + starts, pa.int64()), pa.array(row["doc_n"], pa.int64()),
                pa.array([zlib.crc32(ids[a:z]) for a, z in zip(starts, ends)], pa.int64()),
            ], names=["part", "doc_no", "doc_id", "block", "local", "n", "crc"])


def joined_crc(pieces: pd.Series) -> pd.Series:
    """CRC of each document from those of its pieces, in block order."""
    out = []
    for row in pieces:
        crc = row[0]["crc"]
        for p in row[1:]:
            crc = crc_join(crc, p["crc"], 4 * p["n"])
        out.append(crc)
    return pd.Series(out, dtype="int64")


def read_documents(blocks: DataFrame) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32."""
    totals = blocks.groupBy("part").agg(F.sum(F.col("n").cast("long")).alias("ids"))
    # One row per file: the file numbers are in doc_id order.
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select("part", before.alias("before"))
    pieces = blocks.select("part", "block", "first", "doc_no", "doc_id", "doc_n", "payload").mapInArrow(piece_rows, PIECES)
    # Only documents that go over a block's end have more than one piece.
    docs = pieces.groupBy("part", "doc_no").agg(
        F.min("doc_id").alias("doc_id"), F.min("local").alias("local"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "crc", "n"))).alias("pieces"))
    return docs.join(totals, "part").select(
        "doc_id", (F.col("local") + F.col("before")).alias("start"), "n_tokens",
        F.when(F.size("pieces") == 1, F.col("pieces")[0]["crc"]).otherwise(F.pandas_udf(joined_crc, "long")("pieces")).alias("ids_crc32"))


def token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    folder = shared_dir(docs.sparkSession, "token-files")
    return read_documents(write_tokens(docs, folder, tokenizer, end_id))


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(load(spark, sf_dir, "documents"), default_tokenizer())
