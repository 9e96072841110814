"""The mixing model against a plain Python one that goes place by place, and the score of a document from its parts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from docloom.llm import lm_score as L
from tests.llm.conftest import documents


class Plain:
    """One number at a time: counts by slot, weights by gate, a map by byte before and level."""

    def __init__(self):
        self.seen = [defaultdict(lambda: [0.0, 0.0]) for _ in L.SLOT_BITS]
        self.odds = [defaultdict(float) for _ in L.SLOT_BITS]
        self.weights = [defaultdict(lambda: 0.3) for _ in L.SLOT_BITS]
        self.slopes = [defaultdict(lambda: 1e-3) for _ in L.SLOT_BITS]
        self.map = defaultdict(lambda: [0.0, 0.0])

    def bits(self, p, learn):
        out = []
        for lo in range(0, len(p.byte), L.ROWS):
            part = L.Places(*(x[lo:lo + L.ROWS] for x in p))
            starts = L.slots(L.contexts(part))
            old, total = {k: list(v) for k, v in self.map.items()}, float(sum(part.times))
            slopes = defaultdict(float)
            for i in range(len(part.byte)):
                byte, place, near, times, bits = int(part.byte[i]), int(part.place[i]), int(part.last[i]) & 255, float(part.times[i]), 0.0
                for bit in range(8):
                    node, one = 1 << bit | byte >> (8 - bit), byte >> (7 - bit) & 1
                    at = [int(s[i]) ^ int(path[node]) for s, path in zip(starts, L.PATHS)]
                    x = [self.odds[m][a] for m, a in enumerate(at)]
                    gate = sum(place >= edge for edge in (1, 3, 6)) * 10 + math.ceil(min(abs(x[3]), 6) * 2 / 3) + 5 * (x[4] != 0) + 40 * bit
                    mixed = max(-12, min(12, sum(self.weights[m][gate] * v for m, v in enumerate(x))))
                    chance = 1 / (1 + math.exp(-mixed))
                    level = int(max(-8, min(8, mixed)) * 2 + 16.5)
                    zeros, ones = old.get((near, level), (0.0, 0.0))
                    centre = 1 / (1 + math.exp(8 - level / 2))
                    final = (chance + (ones + L.MAP_PRIOR * centre) / (zeros + ones + L.MAP_PRIOR)) / 2
                    bits -= math.log2(final if one else 1 - final)
                    if learn:
                        for m, v in enumerate(x):
                            slopes[m, gate] += (one - chance) * times / total * v
                        self.map[near, level][one] += times
                        for m, a in enumerate(at):
                            self.seen[m][a][one] += times
                out.append(bits)
            for (m, gate), s in slopes.items():
                self.slopes[m][gate] += s * s
                self.weights[m][gate] += L.RATE * s / math.sqrt(self.slopes[m][gate])
        return out

    def settle(self):
        for m, table in enumerate(self.seen):
            self.odds[m].update({a: math.log((c[1] + L.PRIOR) / (c[0] + L.PRIOR)) for a, c in table.items()})


def texts(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aabcdeé") for _ in range(rng.randint(1, 9))) for _ in range(25)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_bits_against_plain_python(monkeypatch):
    monkeypatch.setattr(L, "ROWS", 150)
    model, counts, plain = L.Model(), L.Counts(), Plain()
    some = texts(60, 1)
    for lo in (0, 20, 40):
        p, _, _ = L.places(L.tokenise(pa.array(some[lo:lo + 20])))
        assert np.allclose(model.bits(p, counts), plain.bits(p, True), rtol=2e-3, atol=2e-3)
        counts.show(model)
        plain.settle()
    p, _, _ = L.places(L.tokenise(pa.array(texts(10, 2) + some[:5] + [None, ""])))
    got, want = model.bits(p), plain.bits(p, False)
    assert np.allclose(got, want, rtol=5e-3, atol=5e-3)
    assert abs(model.weights - 0.3).max() > 0.01 and 0 < sum(want) < 8 * len(want)


@pytest.mark.parametrize("common", [1 << 18, 5])
def test_score_from_its_parts(spark, common):
    rows = [(i, t, "s") for i, t in enumerate(texts(50, 3))] + [(90, None, "s"), (91, "Unseen WORDS here", "s")]
    got = {r.doc_id: r for r in L.score(documents(spark, rows).coalesce(1), common).collect()}
    held = {d: r.held_out for d, r in got.items()}
    words = lambda t: (t or "").lower().split() + ["\n"]
    seen = Counter(w for d, t, _ in rows if not held[d] for w in words(t))
    model, counts = L.Model(), L.Counts()
    p, _, _ = L.places(L.tokenise(pa.array([t for d, t, _ in rows if not held[d]], pa.string())))
    model.bits(p, counts)
    counts.show(model)
    n, v = sum(seen.values()), len(seen)
    for d, t, _ in rows:
        s = L.tokenise(pa.array([t], pa.string()))
        p, head, group = L.places(s)
        heads = int(head.max()) + 1
        cost = np.bincount(group, model.bits(p), heads + len(s.sizes))
        bits = cost[head] + cost[heads + s.tokens]
        want = sum(math.log10((seen[w] + v * 2.0 ** -b) / (n + v)) for w, b in zip(words(t), bits))
        assert math.isclose(got[d].score, want, rel_tol=1e-4), (d, got[d].score, want)
        assert got[d].n_tokens == len(bits)
