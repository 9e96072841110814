"""Conversation prefix trie by union-find over the common prefixes of sorted neighbours (operator 12).

A sequence is the digests of a conversation's turns, 16 bytes each. Sequences are dealt out by range and sorted, so all that share a
prefix are neighbours. A block of sorted sequences (an Arrow batch) takes the edges between neighbours in descending order of their common prefix:
the edge joins two components at that depth, where a branching node begins, and whatever lay between it and the components' tops
is a path of nodes with one child each. A node whose interval ends inside its block is complete there. The others are prefixes of the block's
first or last sequence: they alone are handed on as the contracted forest of the block, and are merged with those of the neighbouring blocks by their prefix digest,
first within a partition, then ``FAN`` partitions at a time, until one forest is left. So a round reads at most two paths per block, however many conversations
share a prefix.

Ends: the conversations that end in a node are hashed in ascending order of their ids, from pieces of up to ``PIECE`` ids made in
parallel; a node's pieces are read as a stream, so nothing but the running hash is held.

Defined results: turns are ordered by turn (null first), then by the MD5 of the turn, so that no text is shuffled; null role and text are empty; repeated rows are turns of
their own; rows without a conversation id belong to no conversation; a conversation without turns ends in the root;
an empty table has no root and gives no rows; other columns are not read. One sequence, 16 bytes a turn, must fit a row; texts and groups of equal
conversations may have any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.common import WORD
from docloom.llm.registry import query
from docloom.session import materialise
from docloom.sources.tables import load

#: Partitions whose forests are merged in one task.
FAN = 32
#: Ids of a node that are written to one piece.
PIECE = 4096
#: Neighbouring turns of one conversation are numbered together in ranges of so many turn numbers.
TURNS = 256

NODES = ("node binary, parent binary, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, last_words long, at long, is_first boolean, is_last boolean, is_open boolean")
NAMES = [c.split()[0] for c in NODES.split(", ")]


class Forest:
    """Columns of nodes that a task hands on; a node knows its row's number so that its children can name it."""

    def __init__(self) -> None:
        self.rows: list[list] = []

    def add(self, node, parent, depth, conv_id, n, kids, leaves, saved, words, at, first, last, opened) -> int:
        self.rows.append([node, parent, depth, conv_id, None, n, kids, leaves, saved, words, at, first, last, opened])
        return len(self.rows) - 1


def common_prefixes(turns: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Common turns of each sequence with the one before; the first has none."""
    out = np.zeros(len(starts) - 1, np.int64)
    for i in range(1, len(out)):
        a, b = turns[starts[i - 1]:starts[i]], turns[starts[i]:starts[i + 1]]
        n = min(len(a), len(b))
        differ = (a[:n] != b[:n]).any(axis=1)
        out[i] = differ.argmax() if n and differ.any() else n
    return out


def block_forest(ids: np.ndarray, data: np.ndarray, starts: np.ndarray, words: np.ndarray, at: int) -> Forest:
    """Nodes of one block of sorted sequences. ``data``: digests (turn, 2); ``starts``: where each sequence begins, and the end."""
    m, forest = len(ids), Forest()
    common = common_prefixes(data, starts)
    raw = data.tobytes()
    digests: dict[tuple[int, int], bytes] = {}

    def prefix(i: int, depth: int) -> bytes:
        """MD5 of the first turns of sequence i; a sequence's prefixes are digested together, as they are asked for one after the other."""
        if (i, depth) not in digests:
            running = hashlib.md5()
            digests[i, 0] = running.digest()
            for t in range(starts[i + 1] - starts[i]):
                running.update(raw[16 * (starts[i] + t):16 * (starts[i] + t + 1)])
                digests[i, t + 1] = running.digest()
        return digests[i, depth]

    lengths = np.diff(starts)
    up = list(range(m))
    low, high, top = list(range(m)), list(range(m)), lengths.tolist()
    least = ids.tolist()
    # Of the top node's complete children: how many, their leaves and saved tokens, and their rows, which wait for the parent's id.
    kids, leaves, saved, waiting = [0] * m, [0] * m, [0] * m, [[] for _ in range(m)]

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def lower(c: int, depth: int) -> None:
        """Emits the path from the top of component c down to above ``depth``; its top is then at ``depth``."""
        n, lo = high[c] - low[c] + 1, low[c]
        first, last = lo == 0, high[c] == m - 1
        for d in range(top[c], depth, -1):
            last_words = int(words[starts[lo] + d - 1]) if d else 0
            node, parent = prefix(lo, d), prefix(lo, d - 1) if d else None
            if first or last:
                row = forest.add(node, parent, d, least[c], n, kids[c], leaves[c], saved[c], last_words, at, first, last, True)
                after = (0, 0, 0, [])
            else:
                ended, total = leaves[c] or 1, saved[c] + (n - 1) * last_words
                row = forest.add(node, parent, d, least[c], n, kids[c], ended, total, last_words, at, False, False, False)
                after = (1, ended, total, [row])
            for child in waiting[c]:
                forest.rows[child][4] = least[c] if not (first or last) else None
            kids[c], leaves[c], saved[c], waiting[c] = after
        top[c] = depth

    for i in np.argsort(-common[1:], kind="stable") + 1:
        a, b, depth = find(i - 1), find(i), int(common[i])
        for c in (a, b):
            lower(c, depth)
        up[b] = a
        high[a] = high[b]
        least[a] = min(least[a], least[b])
        kids[a] += kids[b]
        leaves[a] += leaves[b]
        saved[a] += saved[b]
        waiting[a] += waiting[b]
    lower(find(0), -1)
    return forest


def table_of(forest: Forest) -> pa.RecordBatch:
    types = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
    columns = list(zip(*forest.rows)) or [()] * len(NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, types[k.split()[1]]) for c, k in zip(columns, NODES.split(", "))], names=NAMES)


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: sorted (conv_id, sequence, words) to the nodes of each batch; ``at`` orders the blocks of the whole table."""
    part = TaskContext.get().partitionId() << 32
    for k, b in enumerate(batches):
        if not b.num_rows:
            continue
        sizes = np.array([len(x) // 16 for x in b.column(1).to_pylist()], np.int64)
        data = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint64).reshape(-1, 2)
        words = b.column(2).flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        yield table_of(block_forest(b.column(0).to_numpy(), data, starts, words, part + k))


def merged_rows(frame: pd.DataFrame, all_of_it: bool) -> Forest:
    """Merges the open nodes of neighbouring blocks; those inside their outer boundaries are complete. ``all_of_it``: there is nothing beyond them."""
    lo, hi = frame["at"].min(), frame["at"].max()
    nodes: dict[bytes, list] = {}
    for r in frame[[*NAMES]].itertuples(index=False):
        first, last = r.is_first and r.at == lo and not all_of_it, r.is_last and r.at == hi and not all_of_it
        x = nodes.get(r.node)
        if x is None:
            nodes[r.node] = [r.parent, r.depth, r.conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.last_words, first, last, []]
        else:
            x[2] = min(x[2], r.conv_id)
            for k, v in ((3, r.n_convs), (4, r.n_children), (5, r.n_leaves), (6, r.saved_tokens)):
                x[k] += v
            x[8] |= first
            x[9] |= last
    forest = Forest()
    for node, (parent, depth, conv_id, n, kids, leaves, saved, words, first, last, waiting) in sorted(nodes.items(), key=lambda x: -x[1][1]):
        opened = first or last
        if not opened:
            leaves, saved = leaves or 1, saved + (n - 1) * words
            for child in waiting:
                forest.rows[child][4] = conv_id
        # The group counts as one block from now on.
        row = forest.add(node, parent, depth, conv_id, n, kids, leaves, saved, words, lo, first, last, opened)
        if not opened and parent is not None:
            up = nodes[parent]
            up[4] += 1
            up[5] += leaves
            up[6] += saved
            up[10].append(row)
    return forest


def merged(rows: DataFrame, shift: int, all_of_it: bool) -> DataFrame:
    def body(frame: pd.DataFrame) -> pd.DataFrame:
        return table_of(merged_rows(frame, all_of_it)).to_pandas(integer_object_nulls=True)

    return rows.groupBy(F.expr(f"at div {shift}L").alias("group")).applyInPandas(body, NODES)


def trie(sequences: DataFrame) -> DataFrame:
    """One row per distinct prefix. ``sequences``: conv_id, sequence (turn digests, concatenated), words (of each turn).

    Columns: node, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = sequences.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ordered = sequences.repartitionByRange(n, "sequence", "conv_id").sortWithinPartitions("sequence", "conv_id")
    parts = [materialise(ordered.select("conv_id", "sequence", "words").mapInArrow(block_rows, NODES), "trie-blocks")]
    # All blocks of a partition, then FAN partitions, then FAN times as many.
    width = 1
    while True:
        opened = parts[-1].filter("is_open")
        parts.append(materialise(merged(opened, width << 32, width >= n), "trie-merged"))
        if width >= n:
            break
        width *= FAN
    # Nodes that became complete while merging are few; the children of these that did so before look their ids up.
    late = None
    for part in parts[1:]:
        done = part.filter("NOT is_open").select(F.col("node").alias("late_node"), F.col("conv_id").alias("late_id"))
        late = done if late is None else late.union(done)
    nodes = None
    for part in parts:
        done = part.filter("NOT is_open").drop("at", "is_first", "is_last", "is_open")
        nodes = done if nodes is None else nodes.union(done)
    known = nodes.filter("parent_conv_id IS NOT NULL OR depth = 0")
    asked = nodes.filter("parent_conv_id IS NULL AND depth > 0").join(late, F.col("parent") == F.col("late_node"))
    nodes = known.union(asked.select(*[F.col("late_id").alias("parent_conv_id") if c == "parent_conv_id" else F.col(c) for c in known.columns]))
    out = nodes.join(ends(sequences), "node", "left")
    return out.select("node", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def hashed_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: (node, first, ids) sorted by node and first id to (node, SHA-256 of all its ids, comma-joined)."""
    last, running = None, None

    def ended(nodes: list, hashes: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(hashes, pa.string())], names=["node", "ends_sha256"])

    for b in batches:
        nodes, hashes = [], []
        for node, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            if node == last:
                running.update(b",")
            else:
                if last is not None:
                    nodes.append(last)
                    hashes.append(running.hexdigest())
                last, running = node, hashlib.sha256()
            running.update(ids.encode())
        yield ended(nodes, hashes)
    if last is not None:
        yield ended([last], [running.hexdigest()])


def ends(sequences: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes in which sequences end."""
    rows = sequences.select(F.unhex(F.md5("sequence")).alias("node"), "conv_id", F.expr(f"conv_id div {PIECE}").alias("piece"))
    pieces = rows.groupBy("node", "piece").agg(F.min("conv_id").alias("first"), F.array_sort(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select("node", "first", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashed_pieces, "node binary, ends_sha256 string")


def digest(role: Column, text: Column) -> Column:
    """Hexadecimal digest of a turn; the length keeps role and text apart."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def numbered(turns: DataFrame) -> DataFrame:
    """Conversation, place from 0, digest and words of every turn.

    Turns are numbered within ranges of ``TURNS`` turn numbers, and the ranges' sizes are added up, so that a long
    conversation is numbered by many tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.expr(f"turn div {TURNS}").alias("range"), digest(role, text).alias("digest"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).alias("words"))
    within = Window.partitionBy("conv_id", "range").orderBy(F.col("turn").asc_nulls_first(), "digest")
    rows = rows.withColumn("k", F.row_number().over(within) - 1)
    sizes = rows.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("conv_id").orderBy(F.col("range").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("conv_id").alias("c"), F.col("range").alias("r"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    same = (F.col("conv_id") == F.col("c")) & F.col("range").eqNullSafe(F.col("r"))
    return rows.join(sizes, same).select("conv_id", (F.col("k") + F.col("before")).alias("place"), "digest", "words")


def sequences_of(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, sequence, words) of every conversation of ``convs``. ``turns``: conv_id, place, digest, words."""
    turn = F.struct("place", "digest", "words")
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    gathered = gathered.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda x: x["digest"]), "")).alias("sequence"),
                               F.transform("t", lambda x: x["words"]).alias("words"))
    empty = F.array().cast("array<int>")
    return convs.join(gathered, "conv_id", "left").select(
        "conv_id", F.coalesce("sequence", F.lit(b"")).alias("sequence"), F.coalesce("words", empty).alias("words"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations as they are."""
    turns = numbered(conversations)
    return trie(materialise(sequences_of(conversations.select("conv_id").filter("conv_id IS NOT NULL").distinct(), turns), "sequences"))


def regrouped(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Turns of the rebuilt conversations: the first h turns of the group's first conversation, then a conversation's own from the h-th on."""
    heads = F.pmod(F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")), F.lit(4))
    convs = convs.select("conv_id", heads.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base"))
    early = turns.filter((F.col("place") < 3) & (F.col("conv_id") % 20 == 0)).withColumnRenamed("conv_id", "base")
    lent = convs.filter("h > 0").join(early, "base").filter("place < h").select("conv_id", "place", "digest", "words")
    n_lent = lent.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_lent"))
    starts = convs.join(n_lent, "conv_id", "left").select("conv_id", "h", F.coalesce("n_lent", F.lit(0)).alias("n_lent"))
    own = turns.join(starts, "conv_id").filter("place >= h").select("conv_id", (F.col("place") - F.col("h") + F.col("n_lent")).alias("place"), "digest", "words")
    return lent.union(own)


ORACLE = r"""WITH crc AS (SELECT c, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS v
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT c, xor(v, 4294967295) % 4 AS h FROM crc),
m AS (SELECT conv_id AS c, turn, coalesce(text, '') AS text, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m
  FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, m) - 1 AS k, text, m FROM m),
r AS (SELECT v.c, 0 AS own, t.k, text, m FROM convs v JOIN t ON t.c = v.c - v.c % 20 AND t.k < v.h
  UNION ALL SELECT v.c, 1, t.k, text, m FROM convs v JOIN t ON t.c = v.c AND t.k >= v.h),
s AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, k) AS d, text, m FROM r),
p AS (SELECT c, d, md5(string_agg(m, '') OVER (PARTITION BY c ORDER BY d)) AS node,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM s UNION ALL SELECT c, 0, '', 0 FROM convs),
q AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS parent, d = max(d) OVER (PARTITION BY c) AS is_end FROM p),
n AS (SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE is_end), '')) AS ends_sha256 FROM q GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
below AS (SELECT DISTINCT a.node, b.node AS lower FROM q a JOIN q b ON a.c = b.c AND b.d >= a.d),
sums AS (SELECT below.node, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM below JOIN n ON n.node = below.lower LEFT JOIN kids ON kids.node = below.lower GROUP BY below.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  saved_tokens::BIGINT AS saved_tokens, n.ends_sha256 FROM n JOIN sums USING (node) LEFT JOIN kids USING (node) LEFT JOIN n u ON u.node = n.parent"""


@query("op12_prefix_trie", ORACLE)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = load(spark, sf_dir, "conversations")
    turns = materialise(numbered(conversations), "turns")
    convs = turns.select("conv_id").distinct()
    rebuilt = materialise(sequences_of(convs, regrouped(turns, convs)), "sequences")
    return trie(rebuilt).select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                "saved_tokens", "ends_sha256")
