"""Bytes behind equal first bytes are predicted and counted once, with the results of all of them."""

import numpy as np
import pyarrow as pa

from docloom.llm import lm_score as L

WORDS = ["pre" + "fix" * k + tail for k in range(6) for tail in ("", "a", "ab", "z", "é")]


def test_alike_places_are_worked_on_once(monkeypatch):
    p, _, _ = L.places(L.tokenise(pa.array([" ".join(WORDS), " ".join(WORDS[::-1])])))
    alike = set(zip(p.byte.tolist(), p.last.tolist(), p.place.tolist(), p.before.tolist()))
    rows, contexts = [], L.contexts
    monkeypatch.setattr(L, "contexts", lambda x: rows.append(len(x.byte)) or contexts(x))
    model, counts = L.Model(), L.Counts()
    assert len(model.bits(p, counts)) == len(p.byte) and sum(rows) == len(alike) < 0.7 * len(p.byte)
    counts.show(model)
    rows.clear()
    got = model.bits(p)
    assert sum(rows) == len(alike)
    one_by_one = [model.bits(L.Places(*(x[i:i + 1] for x in p)))[0] for i in range(0, len(got), 7)]
    assert np.allclose(got[::7], one_by_one, rtol=1e-5)


def test_counts_are_those_of_all_places(monkeypatch):
    monkeypatch.setattr(L, "WAITING", 50)
    p, _, _ = L.places(L.tokenise(pa.array([" ".join(WORDS), None, "", " ".join(WORDS * 3)])))
    counts = L.Counts()
    L.Model().bits(p, counts)
    counts.settle()
    want = [np.zeros_like(t) for t in counts.tables]
    byte = p.byte.astype(np.int64)
    for table, slot, path in zip(want, L.slots(L.contexts(p)), L.PATHS):
        for bit in range(8):
            np.add.at(table, 2 * (slot ^ path[1 << bit | byte >> (8 - bit)]) + (byte >> (7 - bit) & 1), p.times)
    assert all((a == b).all() for a, b in zip(counts.tables, want))


def test_unique_as_numpy_has_it():
    rng = np.random.default_rng(1)
    for key in (rng.integers(0, 1 << 20, 3000), rng.integers(0, 40, 3000), rng.integers(1 << 58, 1 << 62, 30).repeat(2), np.zeros(1, np.int64)):
        want = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        assert all((a == b).all() for a, b in zip(L.unique(key), want))
