"""Near copies by five-word similarity, against plain Python; the pipeline's stage leaves none."""

from collections import Counter

import corpus_pipeline
from docloom.llm import near_copies
from docloom.sources.tables import load
from tests.llm.conftest import documents
from tests.llm.test_operators import same_columns

FOLDER = "/root/testdata/sf0.001"


def cut(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def similar(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def test_first_of_each_against_plain_python(spark, docs, rows, none):
    # Chains: each differs from the next in one word, the ends of the chain are no near copies.
    words = [f"w{i}" for i in range(100)]
    chain = [(900 + k, " ".join([f"x{i}" if i % 12 == 0 and i // 12 < k else w for i, w in enumerate(words)]), "c") for k in range(8)]
    frame = documents(spark, [*rows, *chain]).repartition(5)
    kept = []
    for d, t, _ in sorted([*rows, *chain], key=lambda r: (r[0] is None, r[0] or 0)):
        s = cut(t)
        if not any(similar(s, x) for _, x in kept):
            kept.append((d, s))
    out = near_copies.first_of_each(frame)
    same_columns(out, frame)
    got = Counter(d for d, in out.select("doc_id").collect() if d not in (5, 6))  # two texts each have these ids
    assert got == Counter(d for d, _ in kept if d not in (5, 6))
    assert sum(got[900 + k] for k in range(8)) > 1
    assert near_copies.first_of_each(none).count() == 0


def test_pipeline_stage_leaves_no_near_copies(spark):
    docs = load(spark, FOLDER, "documents")
    got = corpus_pipeline.near_duplicates(spark, docs, FOLDER).select("doc_id", "text").collect()
    sets = [cut(t) for _, t in got]
    assert not [(got[i][0], got[j][0]) for i in range(len(sets)) for j in range(i) if similar(sets[i], sets[j])]
    assert {1, 6} <= {d for d, _ in got} and not {145, 177} & {d for d, _ in got}


def plain_first(rows):
    kept = []
    for d, t, _ in sorted(rows, key=lambda r: r[0]):
        s = cut(t)
        if not any(similar(s, x) for _, x in kept):
            kept.append((d, s))
    return {d for d, _ in kept}


def half_shared(n):
    """Texts that share 700 of 1,000 words, none near another; some have a near copy."""
    shared = [f"w{i}" for i in range(700)]
    rows = [(i, " ".join(shared + [f"x{i}-{k}" for k in range(300)]), "s") for i in range(n)]
    return rows + [(n + i, rows[i][1] + " tail", "s") for i in range(0, n, 10)]


def counted(monkeypatch):
    calls, real = Counter(), near_copies.materialise
    monkeypatch.setattr(near_copies, "materialise", lambda df, purpose: (calls.update([purpose]), real(df, purpose))[1])
    return calls


def test_rounds_do_not_grow_with_the_texts_of_a_key(spark, monkeypatch):
    rows, calls = half_shared(200), counted(monkeypatch)
    got = near_copies.first_of_each(documents(spark, rows).repartition(4))
    assert {d for d, in got.select("doc_id").collect()} == set(range(200))
    assert calls["open-keys"] <= 4


def revisions():
    """Texts alike but not near (about 0.72 to each other), a chain of near ones among them, and a large group of near copies."""
    words = [f"w{i}" for i in range(600)]
    rows = [(i, " ".join(words[:540] + [f"y{i}-{k}" for k in range(96)]), "s") for i in range(24)]
    rows += [(100 + i, " ".join(words[:20 * i] + [f"z{k}" for k in range(600 - 20 * i)]), "s") for i in range(8)]
    rows += [(200 + i, " ".join(f"v{k}" if k != 7 * i else f"u{i}" for k in range(500)), "s") for i in range(60)]
    return rows


def test_alike_texts_and_small_buckets(spark, monkeypatch):
    rows = revisions()
    want = plain_first(rows)
    assert len(want) > 20 and want & set(range(101, 108))
    for rounds, bucket in ((6, 2048), (1, 2048), (0, 2048), (2, 5)):
        monkeypatch.setattr(near_copies, "ROUNDS", rounds)
        monkeypatch.setattr(near_copies, "BUCKET", bucket)
        got = near_copies.first_of_each(documents(spark, rows).repartition(4))
        assert {d for d, in got.select("doc_id").collect()} == want, (rounds, bucket)
