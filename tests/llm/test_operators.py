"""Each operator against plain Python on the awkward fixture, and on an empty table."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from docloom.llm import decontamination, licenses, line_dedup, lm_score, mixture, quality, sharding, simhash, suffix_dedup, token_files
from tests.llm.conftest import CLASHES, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def bag(rows):
    return Counter(map(tuple, rows))


def same_columns(out, docs):
    assert out.columns == docs.columns
    assert {r["shard"] for r in out.collect()} <= {f"x{CLASHES.index('shard')}"}


# 1

def test_mix_takes_whole_documents_near_the_targets(spark, docs, rows):
    narrow = mixture.sizes(docs).select("doc_id", "source", "size", "place")
    out = mixture.draws(narrow, narrow, shards=5, block_words=50).collect()
    assert len(out) == len(rows)
    assert bag((r.doc_id, r.size) for r in out) == bag((d, len(words(t))) for d, t, _ in rows)
    total = Counter()
    for d, t, s in rows:
        total[s] += len(words(t))
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, target = set(), {}
    while True:
        left = 1.5 * sum(total.values()) - sum(2 * total[s] for s in full)
        open_ = [s for s in order if s not in full]
        target = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_} | {s: 2 * total[s] for s in full}
        over = {s for s in open_ if target[s] > 2 * total[s]}
        if not over:
            break
        full |= over
    taken, largest = Counter(), Counter()
    for r in out:
        assert math.isclose(r.target, target[r.source], rel_tol=1e-12) and r.source_size == total[r.source]
        assert len(r.drawn) <= 2
        taken[r.source] += r.size * len(r.drawn)
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in total)


def test_mix_draws_blocks_once_per_pass_and_shards_evenly(spark, docs):
    narrow = mixture.sizes(docs).select("doc_id", "source", "size", "place")
    blocks = defaultdict(set)
    for r in mixture.draws(narrow, narrow, shards=4, block_words=20).collect():
        for d in r.drawn:
            blocks[r.source, d["pass"], d["block"]].add(d["shard"])
            assert 0 <= d["shard"] < 4
    assert all(len(s) == 1 for s in blocks.values())


def test_splitting_tree_keeps_quotas_and_sizes():
    quotas = np.array([1000, 37, 0, 5, 260])
    split = mixture.split_quotas(quotas, 7, 3)
    assert (split.sum(axis=1) == quotas).all() and (split >= 0).all()
    assert split.sum(axis=0).max() - split.sum(axis=0).min() <= 3
    assert (split == mixture.split_quotas(quotas, 7, 3)).all()


def test_mix_returns_rows_and_keeps_clashing_columns(spark, docs, none):
    out = mixture.mix(docs, shards=3, block_words=30)
    same_columns(out.drop("mix_shard", "mix_place"), docs)
    assert mixture.mix(none).count() == 0


# 2

def test_license_scan(spark, none):
    texts = ["Licensed under CC BY-NC 4.0. cc by, CC-BY", "this is free software: you can redistribute it", None, "", "the license of the land",
             "x " * 500 + "Licensed under the Apache License, Version 2.0.", "All rights\nReserved all rights reserved",
             "This work is licensed under the GNU General Public License, version 3.", "reserved public by cc", "Released under the MIT License."]
    got = {r.doc_id: r for r in licenses.scan(documents(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
        hits = {k: [j for j in range(len(w)) if w[j:j + len(p.split())] == p.split()] for k, p in licenses.BASE.items()}
        starts = [s for h in hits.values() for s in h]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(starts), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted(k for k in hits if hits[k]))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[0].labels == "cc-by,cc-by-nc" and got[5].labels == "apache-2.0" and got[9].labels == "mit" and got[4].labels == "" == got[8].labels
    assert got[5].spans[0]["start"] == 500
    assert licenses.scan(none).count() == 0


# 3

@pytest.mark.parametrize("common", [1_000_000, 3])
def test_lm_base_counts_and_score(spark, docs, rows, none, common):
    tokens = [(d, words((t or "").translate(LOW)) + ["\n"], zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2) for d, t, _ in rows]
    c = Counter(w for _, ws, out in tokens if not out for w in ws)
    n, v = sum(c.values()), len(c)
    expected = sorted((-1 if d is None else d, out, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
                      for d, ws, out in tokens)
    got = lm_score.score(docs, common).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expected
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_score.score(none).count() == 0


def test_lm_is_a_distribution_and_learns():
    import pyarrow as pa

    model, counts = lm_score.Model(), lm_score.Counts()
    text = pa.array(["the cat sat on the mat and the dog sat on the cat " * 20] * 4)
    first = None
    for _ in range(6):
        s = lm_score.tokenise(text)
        p, _, _ = lm_score.places(s)
        bits = model.bits(p, counts)
        first = first if first is not None else float((bits * p.times).sum())
        counts.show(model)
    assert float((model.bits(p) * p.times).sum()) < 0.2 * first
    # The chances of all bytes in one place add up to one.
    one = lm_score.Places(*(np.repeat(x[:1], 256) for x in p))._replace(byte=np.arange(256, dtype=np.uint8))
    assert abs(np.exp2(-model.bits(one)).sum() - 1) < 1e-3


def test_lm_without_training_documents(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm_score.score(documents(spark, [(held, "a b", "s")])).first()
    assert r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and r.score < 0


# 4

@pytest.mark.parametrize("small", [False, True])
def test_suffix_dedup(spark, docs, rows, none, small):
    length, count = 40, Counter()
    data = [(d, (t or "").encode()) for d, t, _ in rows]
    for _, b in data:
        count.update(b[i:i + length] for i in range(len(b) - length + 1))
    expected = []
    for d, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        expected.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    kw = {"shard_bytes": 300, "merge_rows": 50} if small else {}
    out = suffix_dedup.remove_repeats(docs, length, 8, **kw).drop("spans")
    assert bag(out.collect()) == bag(expected)
    assert suffix_dedup.remove_repeats(none).count() == 0


# 5

def test_token_files(spark, docs, rows, none, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "BLOCK_IDS", 100)
    path = token_files.default_tokenizer()
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    got = token_files.token_files(docs, path).orderBy("start").collect()
    ids = {t: tok.encode(t or "", add_special_tokens=False).ids + [2] for _, t, _ in rows}
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert bag((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == bag((d, len(ids[t]), crc(ids[t])) for d, t, _ in rows)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert token_files.token_files(none, path).count() == 0


def test_codes_give_any_id():
    ids = np.random.default_rng(0).integers(0, 1 << 20, 3000).astype(np.uint32)
    ids[::5] %= 200
    codes = token_files.Codes(token_files.encode_levels(ids))
    assert (codes.all() == ids).all() and [codes[i] for i in range(0, 3000, 7)] == ids[::7].tolist() and len(codes) == 3000
    a, b = b"abc" * 50, b"" + b"xyz" * 9
    assert token_files.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


# 6

def plain_scores(rows, trusted):
    """The likelihood ratio of each (doc_id, text), from scratch."""
    def buckets(w):
        h = [xxhash.xxh64_intdigest(x.translate(LOW).encode(), 42) for x in w]
        pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(h, h[1:])]
        return [x & (quality.BUCKETS - 1) for x in h + pairs]

    found = [(d, buckets(words(t))) for d, t in rows]
    raw, target = Counter(), Counter()
    for d, f in found:
        raw.update(f)
        if d in trusted:
            target.update(f)
    share = sum(target.values()) / sum(raw.values())
    ratio = {b: math.log((target[b] + quality.PRIOR * share) / ((raw[b] + quality.PRIOR) * share)) for b in raw}
    return [sum(ratio[b] for b in f) / len(f) if f else None for _, f in found]


def test_quality(spark, docs, rows, none):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 20)] + [(3, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    expected, texts = [], []
    for d, t, _ in rows:
        w = words(t)
        windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = set()
        for i in range(len(w) - 4):
            if windows[tuple(w[i:i + 5])] > 1:
                covered.update(range(i, i + 5))
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        expected.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered)))
        texts.append(w)
    out = quality.quality(docs, labels).collect()
    assert bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out) == bag(expected)
    score = {(d, len(w)): x for (d, _, _), w, x in zip(rows, texts, plain_scores([(d, t) for d, t, _ in rows], set(range(20)) - {3, 5}))}
    for r in out:
        want = score[r.doc_id, r.n_words]
        assert (r.score is None) == (want is None) and (want is None or math.isclose(r.score, want, abs_tol=1e-9))
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and (r.score or 0) >= quality.THRESHOLD)
    same_columns(quality.good_documents(docs, labels), docs)
    assert quality.good_documents(none, labels).count() == 0
    assert quality.quality(docs, labels.limit(0)).filter("not base_failed and not kept").count() == 0


# 7

def plain_fingerprint(text):
    w = words((text or "").translate(LOW))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(prints, bits=2):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("bucket", [512, 1])
def test_simhash_groups(spark, docs, rows, none, bucket):
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    roots = plain_groups(prints)
    ids = defaultdict(list)
    for (d, _, _), r in zip(rows, roots):
        ids[r] += [d] if d is not None else []
    expected = bag((d, f"{p:016x}", min(ids[r], default=None)) for (d, _, _), p, r in zip(rows, prints, roots))
    assert bag(simhash.near_duplicates(docs, bucket).collect()) == expected
    kept = simhash.one_of_each(docs, bucket)
    same_columns(kept, docs)
    assert sorted((d is None, d or 0) for d, in kept.select("doc_id").collect()) == sorted((not v, min(v, default=0)) for v in (ids[r] for r in set(roots)))
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each(none).count() == 0


def test_simhash_links_are_complete(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 60, dtype=np.int64)
    flips = [int(b) ^ sum(1 << int(k) for k in rng.choice(63, n, replace=False)) for b in base for n in (0, 1, 2, 3)]
    prints = sorted(set(flips))
    roots = plain_groups(prints)
    marked = spark.createDataFrame(list(enumerate(prints)), "doc_id long, fp long")
    for bucket in (512, 1):
        got = {r.fp: r.component_id for r in simhash.groups(marked, bucket).collect()}
        least = {}
        for i, r in enumerate(roots):
            least[r] = min(least.get(r, i), i)
        assert got == {p: least[r] for p, r in zip(prints, roots)}


# 8

def test_benchmark_leaks(spark, docs, rows, none):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    long_words = fold(rows[-3][1])
    items = [(1, " ".join(long_words[100:140])), (2, " ".join(long_words[1000:1030]).translate({v: k for k, v in LOW.items()}) + "!"), (3, "never seen " * 9 + "at all here"), (4, "one two"),
             (5, None), (6, " "), (1, " ".join(long_words[100:140])), (7, " ".join(fold(rows[40][1])[:30])), (None, " ".join(long_words[5:50]))]
    table = spark.createDataFrame(items, "item_id long, text string")
    expected, dirty = {}, set()
    for item, text in items:
        w = fold(text)
        if not w:
            continue
        k = min(5, len(w))
        s = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
        for d, t, _ in rows:
            x = fold(t)
            shared = len(s & {tuple(x[i:i + k]) for i in range(len(x) - k + 1)})
            if shared / len(s) >= 0.8:
                expected[d, item] = (len(s), shared)
                dirty.add((d, t))
    hits = decontamination.contained_items(docs, table).collect()
    assert {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in hits} == expected and {i for _, i in expected} >= {1, 2, 4, 7, None}
    clean = decontamination.decontaminate(docs, table)
    same_columns(clean, docs)
    assert bag(clean.select("doc_id", "text").collect()) == bag((d, t) for d, t, _ in rows if (d, t) not in dirty)
    assert decontamination.contained_items(none, table).count() == 0 and decontamination.contained_items(docs, table.limit(0)).count() == 0


# 9

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2])
def test_line_dedup(spark, none, edits):
    import random

    rng = random.Random(edits)
    base = ["".join(rng.choice("abé ") for _ in range(rng.randint(6, 30))) + "q" for _ in range(25)]

    def change(x):
        x = list(x)
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            k = rng.randrange(len(x))
            x[k:k + rng.choice([0, 1, 1])] = rng.choice(["", "z", "\U0001F600"])
        return "".join(x)

    rows = [(i, "\n".join(change(rng.choice(base)) for _ in range(4)) + "\n \n", "s") for i in range(60)] + [(100, None, "s"), (101, "", "s"), (102, "\n\n", "s")]
    rows += [(200, base[0], "s"), (200, base[0], "s")]
    docs = documents(spark, rows)
    found = [(d, i, x) for d, t, _ in dict.fromkeys(rows) for i, x in enumerate((t or "").split("\n")) if WORD.search(x)]
    first = {}
    for d, i, x in sorted(found, key=lambda f: f[:2]):
        first.setdefault(x, (d, i))
    lines = list(first)
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, x in enumerate(lines):
        for y in lines[:n]:
            if len(x) >= 12 and len(y) >= 12 and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits:
                root[find(x)] = find(y)
    head = {}
    for x in lines:
        head[find(x)] = min(head.get(find(x), first[x]), first[x])
    gone = defaultdict(list)
    for d, i, x in found:
        if head[find(x)] != (d, i):
            gone[d].append(i)
    got = {r.doc_id: list(r.removed) for r in line_dedup.removed_lines(docs, edits, 12).collect()}
    assert got == {d: sorted(v) for d, v in gone.items()}
    out = line_dedup.dedup_lines(docs, edits, 12)
    assert out.columns == docs.columns and out.count() == len(rows)
    texts = {r.doc_id: r.text for r in out.collect()}
    for d, t, _ in rows:
        want = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d])
        assert texts[d] == want
    assert line_dedup.dedup_lines(none).count() == 0


# 10

def test_sharding(spark, docs, rows, none):
    out = sharding.place(docs, sharding.even_topology(8)).collect()
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert len(out) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    keys = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text")
    before = {r.doc_id: r.shard for r in sharding.place(keys, sharding.even_topology(8)).collect()}
    after = {r.doc_id: r.shard for r in sharding.place(keys, sharding.grow(sharding.even_topology(8))).collect()}
    moved = {k for k in before if before[k] != after[k]}
    assert all(after[k] == 8 for k in moved) and 0.08 < len(moved) / 20_000 < 0.15
    counts = Counter(before.values())
    assert max(counts.values()) < 1.1 * min(counts.values())
    # A heavier rack only draws keys into its region.
    heavy = [s._replace(weight=3.0) if (s.region, s.rack) == ("region0", "rack0") else s for s in sharding.even_topology(8)]
    moved = [(before[r.doc_id], r.shard) for r in sharding.place(keys, heavy).collect() if before[r.doc_id] != r.shard]
    region = {s.number: s.region for s in heavy}
    assert all(region[z] == "region0" for _, z in moved)
    assert sharding.place(none, sharding.even_topology(8)).count() == 0


def test_encoder_forgets_and_finds_pieces(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "MEMO_PIECES", 30)
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 60, rng.integers(0, 12))) for _ in range(60)]
    texts += [None, "", " ", "  two  spaces ", "end ", " start", "line\nbreak here", "tab\t and nbsp a", "<|endoftext|> it's.", "a"]
    plain = Tokenizer.from_file(token_files.default_tokenizer())
    plain.encode_special_tokens = True
    encoder = token_files.Encoder(token_files.default_tokenizer(), 2)
    for lo in (0, 5, 40, 0, 60):
        some = texts[lo:lo + 20]
        ids, counts = encoder.encode(pa.array(some, pa.string()))
        want = [plain.encode(t or "", add_special_tokens=False).ids + [2] for t in some]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    assert len(encoder.keys) < 200
