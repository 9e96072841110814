"""Ranked search against plain Python, on awkward documents and items."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from docloom.llm import lexical_search
from tests.llm.conftest import documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [w.translate(LOW) for w in TERM.findall(text or "")]


def plain(docs, items, top=10):
    docs = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(1 for _, c in docs if c), sum(sum(c.values()) for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for d, c in docs:
            m = 10 + 90 * sum(c.values()) * n_docs // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in set(terms(text)) if c[w])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scores)[:top])]
    return Counter(out)


def some_items(rows):
    texts = [t for _, t, _ in rows if t and len(t) > 40]
    items = [(i, t[:120]) for i, t in enumerate(texts[:25])] + [(50, texts[-1]), (51, " ".join(texts[:40])), (52, "zz  ZZ unknown"), (53, None), (54, "?!"), (55, "unknown")]
    return items + items[:3] + [(1, "ONE two"), (None, "one")]


@pytest.mark.parametrize("block, pass_bytes", [(4096, 1 << 24), (7, 1 << 24), (16, 3000)])
def test_ranked_against_plain_python(spark, docs, rows, block, pass_bytes):
    items = some_items(rows)
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, terms string, rank string").repartition(2)
    got = lexical_search.ranked(docs, frame, pass_bytes=pass_bytes, block=block)
    assert Counter(map(tuple, got.collect())) == plain([(d, t) for d, t, _ in rows], items)


def test_empty_tables_and_equal_scores(spark, docs, none):
    items = spark.createDataFrame([(1, "same words")], "item_id long, text string")
    assert lexical_search.ranked(none, items).count() == 0
    assert lexical_search.ranked(docs, items.limit(0)).count() == 0
    copies = documents(spark, [(i if i != 30 else None, "same words" if i % 2 == 0 else "other", "s") for i in range(40)]).repartition(7)
    assert [(r["rank"], r.doc_id) for r in lexical_search.ranked(copies, items).orderBy("rank").collect()] == [(k + 1, 2 * k) for k in range(10)]
    blank = documents(spark, [(1, None, None), (2, "", None), (3, " ?", None)])
    assert lexical_search.ranked(blank, items).count() == 0


def test_masks_are_those_of_the_documents():
    rng = np.random.default_rng(1)
    for n_terms in (1, 9, 70):
        held = rng.random((n_terms, 50)) < 0.08
        masks, order, begin = lexical_search.group_masks(np.packbits(held, axis=1, bitorder="little"), 50)
        assert len({m.tobytes() for m in masks}) == len(masks) and sorted(order) == np.flatnonzero(held.any(axis=0)).tolist()
        for g, m in enumerate(masks):
            for d in order[begin[g]:begin[g + 1] if g + 1 < len(begin) else None]:
                assert (held[:, d] == m).all()
