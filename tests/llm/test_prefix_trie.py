"""The prefix trie against plain Python: many small blocks, copies, nulls, chains."""

import hashlib
import random
import re
import zlib

import pytest

from docloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, place string, depth string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ordered(rows):
    out = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            out.setdefault(c, []).append((turn, role or "", text or ""))
    mark = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    return {c: [r[1:] for r in sorted(t, key=lambda r: (r[0] is not None, r[0] or 0, mark(r)))] for c, t in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = convs.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])
        out[c] = base[:h] + own[h:]
    return out


def plain(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = ({n: 0 for n in nodes} for _ in range(3))
    for n in nodes:
        if n:
            kids[n[:-1]] += 1
    for n, members in nodes.items():
        own = (len(members) - 1) * (len(WORD.findall(n[-1][1])) if n else 0)
        for d in range(len(n) + 1):
            leaves[n[:d]] += kids[n] == 0
            saved[n[:d]] += own
    return sorted((min(m), len(n), min(nodes[n[:-1]]) if n else -1, len(m), kids[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(n)).encode()).hexdigest()) for n, m in nodes.items())


def digest(frame):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in frame.collect())


def rows():
    rng = random.Random(3)
    out = []
    for c in range(120):
        n = rng.choice([1, 1, 2, 3, 5, 8])
        out += [(c, t, rng.choice(["user", None]), rng.choice(["a b", "a", "c d e", "", None])) for t in range(n)]
    out += [(200 + k, t, "system", f"same {t}") for k in range(40) for t in range(4)]                 # a third: copies
    out += [(300 + k, t, "user", f"chain {t}") for k in range(12) for t in range(k + 1)]              # each begins the next
    out += [(400, t, "user", "long") for t in range(600)] + [(401, t, "user", "long") for t in range(599)]
    out += [(20, None, "x", "first"), (20, 1, "y", "tie"), (20, 1, "x", "tie"), (20, 1, "x", "tie"), (None, 0, "user", "nobody's")]
    out += [(-5, 0, "user", "below zero"), (-40, 3, "user", "a"), (-39, 3, "user", "a"), (500, 0, "r", "w" * 5000), (501, 2**40, None, None)]
    rng.shuffle(out)
    return [(*r, "n", "p", "d") for r in out]


@pytest.mark.parametrize("batch, fan", [(10000, 32), (3, 2), (1, 3)])
def test_trie_against_plain_python(spark, monkeypatch, batch, fan):
    monkeypatch.setattr(prefix_trie, "FAN", fan)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        table = rows()
        frame = spark.createDataFrame(table, SCHEMA).repartition(5)
        assert digest(prefix_trie.conversation_trie(frame)) == plain(ordered(table))
        turns = prefix_trie.numbered(frame)
        convs = turns.select("conv_id").distinct()
        got = digest(prefix_trie.trie(prefix_trie.sequences_of(convs, prefix_trie.regrouped(turns, convs)).cache()))
        assert got == plain(rebuilt(ordered(table)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.conversation_trie(empty).count() == 0


def test_turnless_conversations_end_in_the_root(spark):
    convs = spark.createDataFrame([(7, b"", []), (9, b"", [])], "conv_id long, sequence binary, words array<int>")
    assert digest(prefix_trie.trie(convs)) == plain({7: [], 9: []})


def test_pieces_of_a_large_end_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 4)
    ids = [i * 3 - 40 for i in range(100)]
    frame = spark.createDataFrame([(i, b"x" * 16, [1]) for i in ids], "conv_id long, sequence binary, words array<int>").repartition(4)
    got, = prefix_trie.ends(frame).collect()
    assert got.ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
