"""Every registered query of the subpackage and the pipeline, on the smallest tables."""

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from docloom.llm import catalog, mixture, quality
from docloom.llm.token_files import default_tokenizer
from docloom.session import materialise
from docloom.sources.tables import load
from tests import oracle
from tests.llm import test_operators as P
from tests.llm.test_near_copies import cut, similar

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, name):
    diff, _ = oracle.differences(catalog.QUERIES[name](spark, FOLDER), oracle.duck(FOLDER), catalog.ORACLES[name])
    assert diff is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_one_row_per_document(spark, name):
    assert catalog.QUERIES[name](spark, FOLDER).count() == load(spark, FOLDER, "documents").count()


def plain_stage(name, rows, con):
    """What a stage should leave of (doc_id, text, source) rows, in plain Python; for the mix, by its SQL."""
    if name == "quality rules":
        trusted = {d for (d,) in con.execute("SELECT doc_id FROM labels GROUP BY 1 HAVING min(quality) = 1 AND max(toxic) = 0").fetchall()}
        scores = P.plain_scores([r[:2] for r in rows], trusted)

        def good(text, score):
            w = P.words(text)
            windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
            covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
            return len(w) >= 10 and 100 * len(covered) <= 20 * len(w) and score >= quality.THRESHOLD

        return [r for r, x in zip(rows, scores) if good(r[1], x)]
    if name == "SimHash near-dedup":
        roots = P.plain_groups([P.plain_fingerprint(r[1]) for r in rows])
        first = {}
        for r, root in sorted(zip(rows, roots), key=lambda x: x[0][0]):
            first.setdefault(root, r)
        kept = []  # then, in order, what is no near copy of a kept one
        for r in first.values():
            found = cut(r[1])
            if not any(similar(found, x) for _, x in kept):
                kept.append((r, found))
        return [r for r, _ in kept]
    if name == "benchmark decontamination":
        fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(P.LOW))
        parts = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        items = [parts(fold(t)) for (t,) in con.execute("SELECT text FROM benchmark").fetchall()]
        return [r for r in rows if all(len(s & parts(fold(r[1]))) < 0.8 * len(s) for s in items)]
    if name == "mixing sources":
        con.register("stage", pd.DataFrame(rows, columns=["doc_id", "text", "source"]))
        taken = con.execute(mixture.DIGEST.replace("FROM documents", "FROM stage")).fetchall()
        times = {d: n // size for d, size, _, _, n in taken}
        return [r for r in rows for _ in range(times[r[0]])]
    tok = Tokenizer.from_file(default_tokenizer())
    tok.encode_special_tokens = True
    out, at = [], 0
    for d, t, _ in sorted(rows):
        ids = tok.encode(t, add_special_tokens=False).ids + [2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_pipeline_against_plain_python(spark):
    docs, con = load(spark, FOLDER, "documents"), oracle.duck(FOLDER)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
        docs = materialise(stage(spark, docs, FOLDER), "stage")
        last = name == corpus_pipeline.STAGES[-1][0]
        assert docs.columns == (["doc_id", "start", "n_tokens", "ids_crc32"] if last else columns)
        got = docs.collect() if last else docs.select("doc_id", "text", "source").collect()
        assert Counter(map(tuple, got)) == Counter(plain_stage(name, rows, con)), name
        assert got


def test_line_keys_are_made_once_and_short_lines_are_found(spark):
    """Index keys are no second row as probes; lines shorter than their segments lose no neighbour."""
    import random

    from pyspark.sql import functions as F

    from docloom.llm import line_dedup

    assert len(line_dedup.probe_keys(F.col("line"), F.col("n"), 2)) == 9
    rng = random.Random(4)
    lines = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(60)})
    lines += sorted({"".join(rng.choice("abé") for _ in range(n)) for n in range(40, 50)})
    lines += [x[:9] + x[10:] for x in lines[-4:]] + [x[:3] + "c" + x[3:30] + "d" + x[30:] for x in lines[-4:]]

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            row, last = [i], row
            for j, d in enumerate(y, 1):
                row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (c != d)))
        return row[-1]

    want = {(i, j) for i, x in enumerate(lines) for j, y in enumerate(lines) if i < j and distance(x, y) <= 2 and x != y}
    df = spark.createDataFrame(list(enumerate(lines)), "a long, line string")
    got = {(r.a, r.b) for r in line_dedup.similar_lines(df).collect()}
    assert {p for p in got if lines[p[0]] != lines[p[1]]} == want and len(want) > 50
