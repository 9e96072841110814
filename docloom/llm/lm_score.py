"""LM scoring by online logistic context mixing (operator 3).

A text is its words (A-Z lower-cased), each with a space behind it, and an end mark. Its bytes are
predicted bit by bit. Five predictors each hash their context (the last 2 or 3 bytes of the word so
far; a longer stretch of it; all of it with the place in the word; and, for a word's first bytes, the
word before) and the bits of the byte so far to a slot with counts of zeros and ones. Their
log-odds are combined by weights that a gate selects (bit, place in the word, how sure the
whole word so far is, whether the longer stretch has been seen), and the result is refined by an adaptive map from (byte before, log-odds) to
what was really seen. A word is also predicted whole, by its share of the training tokens; the two
chances are weighed by tokens against distinct tokens, as new words come at about that rate. The score is the
sum over tokens of the log10 chance, and bits_per_byte is the same over the bytes of the text as described.

Learning is online in every task: slices of growing size are predicted from what the task has seen, the
weights and the map take the errors, then the counts take the slice. The tasks' counts and maps are
added up and their weights averaged by bits seen. The counts cover all training documents; the tables' size
is a parameter, so the model has a known size however large the corpus.

No context reaches beyond the word before, so equal (word before, first bytes) and equal words of a
slice are predicted once, and of these the bytes behind equal first bytes once in a block. Blocks are worked on in
pieces that fit the processor's cache; what a block teaches is taken in at its end.

Base score: counts per word of all training documents, by 64-bit hash of the word. Words above a count
that at most ``COMMON_WORDS`` words reach are looked up in the task; all others are joined.

Defined results: a null or wordless text is the end mark alone; a null doc_id counts as empty text in
the split into held-out and training documents; repeated rows get a row each; with no training documents every
count is 0 and the model predicts even bits; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.registry import query
from docloom.session import materialise
from docloom.sources.tables import load

#: Slots of each predictor, as powers of two.
SLOT_BITS = (18, 18, 18, 18, 18)
#: Slots that travel together.
CHUNK = 1 << 16
#: Bytes of text per online step: the first, and the largest after doubling.
FIRST_SLICE, LAST_SLICE = 1 << 18, 5 << 20
#: Bytes predicted at a time, between updates of the weights.
ROWS = 1 << 17
#: The same where nothing is learned.
FROZEN_ROWS = 1 << 18
#: Places worked on at a time, so that what a step needs stays in the processor's cache.
PIECE = 1 << 14
#: Sums that the errors of a gate go to in turns, so that neighbours do not wait for each other.
LANES = 4
LANE = np.arange(PIECE) % LANES * 40
#: Places whose bytes wait to be counted, and the bits that hold how often one occurs there.
WAITING = 1 << 19
TIMES_BITS = 64 - 8 - max(SLOT_BITS)
RATE = 0.02
#: Bytes of a word that see the word before.
HEAD = 2
PRIOR = 0.2
GATES = 8 * 4 * 5 * 2
MAP_LEVELS = 33
MAP_PRIOR = 4.0
COMMON_WORDS = 1 << 18
HELD_OUT, FOLDS = 2, 7

SPACE, END = 32, 10
END_HASH = np.uint64(xxhash.xxh64_intdigest(b"\n"))
START_HASH = np.uint64(xxhash.xxh64_intdigest(b""))
# Odd multipliers, from a rule.
SPREAD = [np.uint64(xxhash.xxh64_intdigest(bytes([m]), 3) | 1) for m in range(len(SLOT_BITS))]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


class Slice(NamedTuple):
    """Texts as tokens. Tokens of all texts in a row, each text ending in the end mark."""

    tokens: np.ndarray   # index of the distinct word; the last index is the end mark
    ends: np.ndarray     # one past each text's end mark
    hashes: np.ndarray   # of the distinct words
    data: np.ndarray     # bytes of the distinct words, a space behind each, and the end mark
    starts: np.ndarray   # first byte of each distinct word
    sizes: np.ndarray    # bytes of each, with its space


def tokenise(texts: pa.Array) -> Slice:
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    offsets -= offsets[0]
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    kept = np.concatenate(([0], np.cumsum(real)))[offsets]
    found = flat.filter(pa.array(real)).dictionary_encode()
    words = found.dictionary
    raw = words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    n = len(raw)
    counts = np.diff(kept)
    tokens = np.insert(found.indices.to_numpy().astype(np.int64), kept[1:], n)
    lengths = pc.binary_length(words).to_numpy().astype(np.int64)
    sizes = np.append(lengths + 1, 1)
    data = np.frombuffer(b" ".join([*raw, b"\n"]), np.uint8)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, raw), np.uint64, n)
    return Slice(tokens, np.cumsum(counts + 1), np.append(hashes, END_HASH), data, np.cumsum(sizes) - sizes, sizes)


class Places(NamedTuple):
    """Bytes to predict, each with what its contexts are made of, and how often it occurs."""

    byte: np.ndarray
    last: np.ndarray    # up to eight bytes of the word before it, the nearest lowest
    place: np.ndarray   # in the word
    before: np.ndarray  # hash of the word before; 0 behind the head
    times: np.ndarray


def bytes_before(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    place = (np.arange(len(s.data)) - np.repeat(s.starts, s.sizes)).astype(np.int32)
    last = np.zeros(len(s.data), np.uint64)
    for t in range(1, 9):
        last[t:] |= np.where(place[t:] >= t, s.data[:-t], 0).astype(np.uint64) << np.uint64(8 * (t - 1))
    return last, place


def bits_of(n: int) -> int:
    """Bits that tell n rows apart."""
    return max(n - 1, 1).bit_length()


def ordered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in ascending order and their rows, equal keys by row. The lowest bits of the keys are free for the rows."""
    mask = np.uint64((1 << bits_of(len(key))) - 1)
    both = key | np.arange(len(key), dtype=np.uint64)
    both.sort()
    return both & ~mask, (both & mask).astype(np.int64)


def unique(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``np.unique`` of numbers from 0 with first rows, inverse and counts: rows are sorted with the keys where both fit 64 bits."""
    n = len(key)
    free = bits_of(n)
    if not n or int(key.max()).bit_length() + free > 64:
        return np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    found, order = ordered(key.view(np.uint64) << np.uint64(free))
    new = np.ones(n, bool)
    new[1:] = found[1:] != found[:-1]
    first = np.flatnonzero(new)
    row = np.empty(n, np.int64)
    row[order] = np.cumsum(new) - 1
    index = order[first]
    return key[index], index, row, np.diff(np.append(first, n))


def places(s: Slice) -> tuple[Places, np.ndarray, np.ndarray]:
    """What to predict for a slice; then per token the heads' and the tails' cost rows are found by
    (head of the token, tail of the word): returns places, head row of each token, group of each place.

    Groups number the heads first, then the words' tails.
    """
    last, place = bytes_before(s)
    first = np.concatenate(([True], np.zeros(len(s.tokens) - 1, bool)))
    first[s.ends[:-1]] = True
    previous = np.concatenate(([0], s.tokens[:-1]))
    # A head: the word before (or the start of the text) and the first bytes, fewer at the word's end.
    head_size = np.minimum(s.sizes, HEAD)
    head = np.zeros(len(s.sizes), np.int64)
    for k in range(HEAD):
        head = head << 8 | np.where(k < head_size, s.data[np.minimum(s.starts + k, len(s.data) - 1)], 0)
    key = np.where(first, len(s.sizes), previous) << (8 * HEAD) | head[s.tokens]
    heads, index, row, times = unique(key)
    word = s.tokens[index]
    n = head_size[word]
    spot = np.repeat(s.starts[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    before = np.append(s.hashes, START_HASH)[heads >> (8 * HEAD)]
    tail = np.flatnonzero(place >= HEAD)
    word_times = np.bincount(s.tokens, minlength=len(s.sizes))
    owner = np.repeat(np.arange(len(s.sizes)), s.sizes)[tail]
    spots = np.concatenate((spot, tail))
    group = np.concatenate((np.repeat(np.arange(len(word)), n), len(word) + owner)).astype(np.int32)
    return Places(s.data[spots], last[spots], place[spots],
                  np.concatenate((np.repeat(before, n), np.zeros(len(tail), np.uint64))),
                  np.concatenate((np.repeat(times, n), word_times[owner])).astype(np.float32)), row, group


def contexts(p: Places) -> list[np.ndarray]:
    early = p.place < HEAD
    place = np.minimum(p.place, 255).astype(np.uint64)
    some = lambda k: p.last & np.uint64((1 << 8 * k) - 1)
    whole = (p.last ^ place * SPREAD[1]) * SPREAD[0]
    return [some(2), some(3), np.where(early, whole ^ (p.before >> np.uint64(60)) * SPREAD[2], some(5) * SPREAD[3]), whole,
            np.where(early, (whole ^ p.before) * SPREAD[3], some(4) * SPREAD[4])]


def distinct(p: Places) -> tuple[Places, np.ndarray]:
    """The places that differ, with their occurrences added up, and for each place its row among them.

    Words share first bytes, so many places are alike. Alike ones get the same key and come next to each other;
    what is alike is told by the places themselves. The nearest bytes and the byte lead the key, so that neighbours share slots.
    """
    n = len(p.byte)
    if not n:
        return p, np.empty(0, np.int64)
    some = (p.last & np.uint64((1 << 40) - 1) ^ p.before) * SPREAD[1]
    key = ((p.last ^ p.before * SPREAD[2]) * SPREAD[0] ^ p.place.astype(np.uint64) * SPREAD[1] ^ p.byte) * SPREAD[3]
    key >>= np.uint64(29)
    key |= some >> np.uint64(55) << np.uint64(35)
    for t in range(3):
        key |= (p.last >> np.uint64(8 * t) & np.uint64(31)) << np.uint64(59 - 5 * t)
    key |= (p.byte & np.uint64(31)) << np.uint64(44)
    free = np.uint64(bits_of(n))
    order = ordered(key >> free << free)[1]
    q = Places(*(x.take(order, mode="clip") for x in p))
    new = np.ones(n, bool)
    new[1:] = q.byte[1:] != q.byte[:-1]
    for x in (q.last, q.place, q.before):
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    row = np.empty(n, np.int64)
    row[order] = np.cumsum(new) - 1
    times = np.add.reduceat(q.times.astype(np.float64), first).astype(np.float32)
    return Places(*(x.take(first, mode="clip") for x in q[:4]), times), row


#: Per predictor and bit path of a byte, what moves a context's slot.
PATHS = [np.array([xxhash.xxh64_intdigest(bytes([n]), m) & ((1 << b) - 1) for n in range(256)]) for m, b in enumerate(SLOT_BITS)]
CENTRES = np.tile(1 / (1 + np.exp(8 - np.arange(MAP_LEVELS) / 2)), 256)


def slots(context: list[np.ndarray]) -> list[np.ndarray]:
    """Each predictor's slot for the context alone."""
    out = []
    for m, c in enumerate(context):
        h = (c ^ c >> np.uint64(31)) * SPREAD[m]
        h = (h ^ h >> np.uint64(29)) * SPREAD[m - 1]
        out.append((h >> np.uint64(64 - SLOT_BITS[m])).astype(np.int64))  # what indices are anyway
    return out


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """0 where nothing was seen."""
    return np.log((ones + PRIOR) / (zeros + PRIOR)).astype(np.float32)


class Model:
    def __init__(self):
        self.tables = [np.zeros(1 << b, np.float32) for b in SLOT_BITS]  # log-odds
        self.weights = np.full((len(SLOT_BITS), GATES), 0.3, np.float32)
        self.slopes = np.full((len(SLOT_BITS), GATES), 1e-3)
        self.adaptive = np.zeros((256 * MAP_LEVELS, 2))  # byte and level: zeros, ones

    def bits(self, p: Places, learn: "Counts | None" = None) -> np.ndarray:
        """Bits that each byte takes. With ``learn``, weights and map take the errors, and the slots go there."""
        out = np.empty(len(p.byte))
        step = ROWS if learn is not None else FROZEN_ROWS
        for lo in range(0, len(p.byte), step):
            part, row = distinct(Places(*(x[lo:lo + step] for x in p)))
            zeros, ones = self.adaptive.T
            refined = ((ones + MAP_PRIOR * CENTRES) / (zeros + ones + MAP_PRIOR)).astype(np.float32)
            errors = None if learn is None else Errors(max(float(part.times.sum(dtype=np.float64)), 1.0))
            cost = np.empty(len(part.byte))
            for at in range(0, len(part.byte), PIECE):
                cost[at:at + PIECE] = self.mix(Places(*(x[at:at + PIECE] for x in part)), refined, errors, learn)
            out[lo:lo + step] = cost[row]
            if errors is not None:
                slopes = errors.lanes.reshape(len(SLOT_BITS), 8, LANES, 40).sum(2).reshape(len(SLOT_BITS), GATES)
                self.slopes += slopes * slopes
                self.weights += (RATE * slopes / np.sqrt(self.slopes)).astype(np.float32)
                self.adaptive += errors.map.reshape(-1, 2)
        return out

    def mix(self, p: Places, refined: np.ndarray, errors: "Errors | None", learn: "Counts | None") -> np.ndarray:
        """Bits that each byte takes, by weights and map as they are; all indices are in range, so none is checked."""
        starts = slots(contexts(p))
        byte = p.byte.astype(np.int64)
        stage = np.float32(10) * ((p.place >= 1).astype(np.float32) + (p.place >= 3) + (p.place >= 6))
        # The first two predictors see three bytes at most, which many neighbours share.
        near = (p.last & np.uint64((1 << 24) - 1)) << np.uint64(8) | p.byte
        new = np.ones(len(byte), bool)
        new[1:] = near[1:] != near[:-1]
        first, run = np.flatnonzero(new), np.cumsum(new) - 1
        few = [(table, a.take(first), path) for table, a, path in zip(self.tables[:2], starts, PATHS)]
        others = list(zip(self.tables[2:], starts[2:], PATHS[2:]))
        base = (p.last & np.uint64(255)).astype(np.int64) * MAP_LEVELS
        product = np.ones(len(byte))  # of the eight bits' chances, none of which is below a hundred thousandth
        if errors is not None:
            lane = LANE[:len(byte)]
            share = p.times / np.float32(errors.total)
            times = p.times.astype(np.float64)
            learn.add(starts, byte, times)
        for bit in range(8):
            one = byte >> (7 - bit) & 1
            node = (1 << bit) | byte >> (8 - bit)
            some = node.take(first)
            x = [table.take(a ^ path.take(some, mode="clip"), mode="clip").take(run, mode="clip") for table, a, path in few]
            x += [table.take(a ^ path.take(node, mode="clip"), mode="clip") for table, a, path in others]
            # How sure the whole word so far is, in five steps.
            gate = np.ceil(np.minimum(np.abs(x[3]), np.float32(6)) * np.float32(2 / 3))
            gate += stage
            gate += (x[4] != 0) * np.float32(5)
            gate = gate.astype(np.int64)
            weights = self.weights[:, 40 * bit:40 * bit + 40]
            mixed = weights[0].take(gate, mode="clip") * x[0]
            for m in range(1, len(x)):
                mixed += weights[m].take(gate, mode="clip") * x[m]
            np.clip(mixed, -12, 12, out=mixed)
            chance = 1 / (1 + np.exp(-mixed))
            np.clip(mixed, -8, 8, out=mixed)
            level = base + (mixed * np.float32(2) + np.float32(16.5)).astype(np.int64)
            final = (chance + refined.take(level, mode="clip")) * np.float32(0.5)  # neither is 0 or 1
            is_one = one.astype(np.float32)
            product *= np.abs(is_one - 1 + final)
            if errors is not None:
                error = (is_one - chance) * share
                gate += lane
                for m in range(len(x)):
                    errors.lanes[m, bit] += np.bincount(gate, error * x[m], 40 * LANES)
                np.add.at(errors.map, 2 * level + one, times)
        return -np.log2(product)


class Errors:
    """What the places of one block teach: taken in when all of them have been predicted."""

    def __init__(self, total: float):
        self.total = total
        self.lanes = np.zeros((len(SLOT_BITS), 8, 40 * LANES))
        self.map = np.zeros(2 * 256 * MAP_LEVELS)


class Counts:
    """Zeros and ones per slot; what is added is in the model's tables from the next slice on."""

    def __init__(self):
        self.tables = [np.zeros(2 << b, np.float32) for b in SLOT_BITS]
        self.waiting, self.rows = [[] for _ in SLOT_BITS], 0

    def add(self, starts: list[np.ndarray], byte: np.ndarray, times: np.ndarray) -> None:
        """Bytes behind contexts, by the slots of the contexts. They wait as slot, byte and times in one number each."""
        low = (byte << TIMES_BITS | times.astype(np.int64)).view(np.uint64)
        for waiting, a in zip(self.waiting, starts):
            waiting.append(a.view(np.uint64) << np.uint64(TIMES_BITS + 8) | low)
        self.rows += len(byte)
        if self.rows >= WAITING:
            self.settle()

    def settle(self) -> None:
        """Counts what waits: each distinct byte of a slot once, slots in ascending order."""
        for table, path, waiting in zip(self.tables, PATHS, self.waiting):
            if not self.rows:
                break
            both = np.concatenate(waiting)
            waiting.clear()
            both.sort()
            key = (both >> np.uint64(TIMES_BITS)).astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            both &= np.uint64((1 << TIMES_BITS) - 1)
            times = np.add.reduceat(both, first).astype(np.float32)
            key = key[first]
            slot, byte = key >> 8, key & 255
            for bit in range(8):
                at = slot ^ path.take((1 << bit) | byte >> (8 - bit), mode="clip")
                np.add.at(table, 2 * at + (byte >> (7 - bit) & 1), times)
        self.rows = 0

    def show(self, model: Model) -> None:
        self.settle()
        for m, table in enumerate(self.tables):
            model.tables[m] = log_odds(table[::2], table[1::2])


def slices(batches: Iterator[pa.RecordBatch], column: int, first: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about so many bytes of text, doubling up to LAST_SLICE."""
    size = first
    for b in batches:
        total = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + size, side="right")))
            yield b.slice(lo, hi - lo)
            lo, size = hi, min(2 * size, LAST_SLICE)


LEARNED = "kind string, at long, data binary, n double"


def learn_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: training texts to word counts and what the model has learned from them.

    Rows: word (hash, count), then chunks of the slot counts, the map and the weights.
    """
    model, counts, seen = Model(), Counts(), 0.0
    for b in slices(batches, 0, FIRST_SLICE):
        s = tokenise(b.column(0))
        n = np.bincount(s.tokens, minlength=len(s.sizes))
        yield pa.RecordBatch.from_arrays([
            pa.array(["word"] * len(n)), pa.array(s.hashes.view(np.int64)), pa.nulls(len(n), pa.binary()), pa.array(n.astype(np.float64))],
            names=["kind", "at", "data", "n"])
        p, _, _ = places(s)
        model.bits(p, counts)
        counts.show(model)
        seen += float(p.times.sum())
    if not seen:
        return
    pack = zstandard.ZstdCompressor(level=1)
    rows = [("weights", 0, model.weights.astype(np.float64) * seen, seen), ("map", 0, model.adaptive, 0.0)]
    rows += [(f"slots{m}", at, table[2 * at:2 * (at + CHUNK)].astype(np.float64), 0.0)
             for m, table in enumerate(counts.tables) for at in range(0, len(table) // 2, CHUNK)]
    for kind, at, data, n in rows:
        yield pa.RecordBatch.from_arrays([
            pa.array([kind]), pa.array([at], pa.int64()), pa.array([pack.compress(data.tobytes())], pa.binary()), pa.array([n])],
            names=["kind", "at", "data", "n"])


def add_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: sums arrays that have the same kind and number, one array of each in memory."""
    unpack, total, weight = zstandard.ZstdDecompressor(), {}, {}
    for b in batches:
        for kind, at, data, n in zip(*(b.column(i) for i in range(4))):
            key = kind.as_py(), at.as_py()
            array = np.frombuffer(unpack.decompress(data.as_py()))
            if key in total:
                total[key] += array
            else:
                total[key] = array.copy()
            weight[key] = weight.get(key, 0.0) + n.as_py()
    for (kind, at), array in total.items():
        if kind.startswith("slots"):  # the model only needs the log-odds
            array = log_odds(array[::2], array[1::2])
        yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([at], pa.int64()), pa.array([array.tobytes()], pa.binary()),
                                          pa.array([weight[kind, at]])], names=["kind", "at", "data", "n"])


def train(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the word counts (hash, n) of all documents given."""
    learned = materialise(docs.select("text").mapInArrow(learn_rows, LEARNED), "lm-learned")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = learned.filter("kind <> 'word'").repartition(parts, "kind", "at").mapInArrow(add_chunks, LEARNED)
    model = Model()
    for row in merged.toLocalIterator():  # the model: as many rows as the tables have chunks
        if row["kind"] == "weights":
            model.weights = (np.frombuffer(row["data"]) / row["n"]).reshape(len(SLOT_BITS), -1).astype(np.float32)
        elif row["kind"] == "map":
            model.adaptive = np.frombuffer(row["data"]).reshape(-1, 2)
        else:
            model.tables[int(row["kind"][5:])][row["at"]:row["at"] + CHUNK] = np.frombuffer(row["data"], np.float32)
    words = learned.filter("kind = 'word'").groupBy(F.col("at").alias("word")).agg(F.sum("n").cast("long").alias("n"))
    return model, materialise(words, "lm-words")


def common_words(words: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Least count, hashes (ascending) and counts of the common words: at most ``most``."""
    steps = words.groupBy(F.floor(F.log2("n") * 8).alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("n"))
    least, held = None, 0
    for row in sorted(steps.collect(), key=lambda r: -r["step"]):  # eight rows per doubling of the largest count
        held += row["words"]
        if held > most:
            break
        least = row["n"]
    if least is None:
        return 1 << 62, np.empty(0, np.int64), np.empty(0, np.int64)
    found = words.filter(F.col("n") >= least).toPandas().sort_values("word")
    return least, found["word"].to_numpy(np.int64), found["n"].to_numpy(np.int64)


SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, n_bytes long, logs_mixed double, known long, logs double, "
          "word long, bits double")


def score_rows(model, common, tokens: int, distinct: int):
    """Task body: documents to a row each (sums over their common words) and a row for each other token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, (hashes, counts) = model.value, common.value
        row = TaskContext.get().partitionId() << 40
        names = [f.split()[0] for f in SCORED.split(", ")]
        whole = 1 / max(tokens + distinct, 1)  # what one count is worth
        spelt = distinct / (tokens + distinct) if tokens else 1.0
        for b in slices(batches, 2, LAST_SLICE):
            s = tokenise(b.column(2))
            p, head, group = places(s)
            heads = int(head.max()) + 1
            cost = np.bincount(group, m.bits(p), heads + len(s.sizes))
            bits = cost[head] + cost[heads + s.tokens]
            begins = np.concatenate(([0], s.ends[:-1]))
            n = s.ends - begins
            h = s.hashes.view(np.int64)
            at = np.minimum(np.searchsorted(hashes, h), max(len(hashes) - 1, 0))
            c = np.where(hashes[at] == h, counts[at], 0) if len(hashes) else np.zeros(len(h), np.int64)
            counted = c[s.tokens]
            mixed = np.log10(np.where(counted > 0, counted * whole + spelt * np.exp2(-bits), 1))
            rows = row + np.arange(len(n))
            row += len(n)
            sums = lambda x: pa.array(np.add.reduceat(x, begins))
            yield pa.RecordBatch.from_arrays([
                pa.array(rows), b.column(0), b.column(1), pa.array(n), sums(s.sizes[s.tokens]), sums(mixed),
                sums((counted > 0).astype(np.int64)), sums(np.log10(c + 1.0)[s.tokens]),
                pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.float64())], names=names)
            other = np.flatnonzero(counted == 0)
            none = [pa.nulls(len(other), t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rows, n)[other]), *none, pa.array(h[s.tokens[other]]), pa.array(bits[other])],
                                             names=names)

    return run


def score(docs: DataFrame, common: int = COMMON_WORDS) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    model, words = train(docs.filter(~F.col("held_out")))
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least, hashes, counts = common_words(words, common)
    send = spark.sparkContext.broadcast
    found = docs.mapInArrow(score_rows(send(model), send((hashes, counts)), tokens, distinct), SCORED)
    found = materialise(found, "lm-scored")
    rare = found.filter(F.col("word").isNotNull()).select("row", "word", "bits")
    rare = rare.join(words.filter(F.col("n") < least), "word", "left")
    spelt = F.log10(F.lit(distinct / (tokens + distinct) if tokens else 1.0)) - F.col("bits") * math.log10(2)
    mixed = F.when(F.col("n").isNull(), spelt).otherwise(
        F.log10((F.col("n") + distinct * F.pow(F.lit(2.0), -F.col("bits"))) / F.lit(float(max(tokens + distinct, 1)))))
    rare = rare.groupBy("row").agg(F.count("n").alias("rare_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("rare_logs"),
                                   F.sum(mixed).alias("rare_mixed"))
    rows = found.filter(F.col("word").isNull()).join(rare, "row", "left")
    floor = math.log10(tokens + distinct + 1)
    rows = rows.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        (F.col("logs_mixed") + F.coalesce("rare_mixed", F.lit(0.0))).alias("score"), "n_bytes")
    return rows.withColumn("bits_per_byte", -F.col("score") / (math.log10(2) * F.col("n_bytes"))).drop("n_bytes")


@query("op3_lm_score")
def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(load(spark, sf_dir, "documents"))
