"""Licence scan by a positional index of rare words (operator 2).

Templates are licence notices with key phrases that must be there. Over all documents the document
frequency of every template word is counted, and each template's ``RARE`` words of highest IDF
make the index: word to (template, position). For a document, all its indexed words are looked up,
rarest first, and every posting votes for the place where the template would begin; a place with votes from
different words is compared with the whole template there, word by word and weighted by IDF.
It counts if at least ``MIN_SHARE`` of the weight agrees and a key phrase of the template stands inside the
matched words. The base phrases are templates too, and they are counted at every place.

Defined results: a null or empty text has no words, no places, empty labels and score 0; repeated rows get a row
each; a text of any length is scanned whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import split_words
from docloom.llm.registry import query
from docloom.sources.tables import load

# Phrases of the contract.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

# Common licence notices, and the phrases of which one must be there.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license"]),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0", ["apache org licenses"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files", ["permission is hereby granted", "obtaining a copy of this software"]),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", ["general public license"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation", ["general public license", "free software foundation"]),
    ("lgpl", "under the terms of the GNU Lesser General Public License", ["lesser general public license"]),
    ("agpl", "under the terms of the GNU Affero General Public License", ["affero general public license"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     ["creative commons attribution"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met", ["redistribution and use in source and binary forms"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ["mozilla public license"]),
    ("epl-2.0", "made available under the terms of the Eclipse Public License 2.0", ["eclipse public license"]),
    ("unlicense", "This is free and unencumbered software released into the public domain", ["unencumbered software"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
     ["permission to use copy modify"]),
]

RARE = 4
MIN_SHARE = 0.7

class Template(NamedTuple):
    label: str
    words: list[bytes]
    phrases: list[list[bytes]]


def templates() -> list[Template]:
    found = [Template(label, split_words(text), [split_words(p) for p in phrases]) for label, text, phrases in NOTICES]
    return found + [Template(label, split_words(p), [split_words(p)]) for label, p in BASE.items()]


def places(words: list[bytes], phrase: list[bytes], anchor: int = 0) -> list[int]:
    """Starts of the phrase, overlaps included."""
    out, i = [], anchor - 1
    try:
        while True:
            i = words.index(phrase[anchor], i + 1)
            if words[i - anchor:i - anchor + len(phrase)] == phrase:
                out.append(i - anchor)
    except ValueError:
        return out


class Index:
    """Rare words of the templates with their positions."""

    def __init__(self, all_templates: list[Template], frequency: dict[bytes, int], documents: int):
        self.templates = all_templates
        self.idf = {w: math.log((documents + 1) / (frequency.get(w, 0) + 1)) + 1e-9 for t in all_templates for w in t.words}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.weight, self.votes = [], []
        for n, t in enumerate(all_templates):
            rare = sorted(set(t.words), key=lambda w: (-self.idf[w], w))[:RARE]
            for q, w in enumerate(t.words):
                if w in rare:
                    self.postings[w].append((n, q))
            self.weight.append(sum(self.idf[w] for w in t.words))
            self.votes.append(min(2, len(rare)))
        self.anchor = {label: max(range(len(p)), key=lambda i: self.idf[p[i]]) for label, p in
                       ((label, split_words(p)) for label, p in BASE.items())}

    def find(self, words: list[bytes]) -> list[tuple[str, int, float]]:
        """(label, start, share) of each notice in the document."""
        if self.postings.keys().isdisjoint(words):
            return []
        at: dict[bytes, list[int]] = defaultdict(list)
        for p, w in enumerate(words):
            if w in self.postings:
                at[w].append(p)
        votes: dict[tuple[int, int], int] = Counter()
        for w in sorted(at, key=lambda w: (-self.idf[w], w)):
            for n, q in self.postings[w]:
                votes.update((n, p - q) for p in at[w])
        out = []
        for (n, start), count in votes.items():
            t = self.templates[n]
            if count < self.votes[n]:
                continue
            lo = max(start, 0)
            window = words[lo:start + len(t.words)]
            share = sum(self.idf[w] for w, x in zip(t.words[lo - start:], window) if w == x) / self.weight[n]
            if share >= MIN_SHARE and any(places(window, p) for p in t.phrases):
                out.append((t.label, lo, min(share, 1.0)))
        return sorted(out)


def texts_of(batch: pa.RecordBatch, column: int) -> Iterator[str]:
    for x in batch.column(column):
        yield x.as_py() or ""


def frequencies(docs: DataFrame) -> tuple[dict[bytes, int], int]:
    """Documents that hold each template word, and all documents: one row per template word and task is shuffled."""
    vocabulary = frozenset(w for t in templates() for w in t.words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            found[""] += b.num_rows
            for text in texts_of(b, 0):
                found.update(w.decode() for w in vocabulary.intersection(split_words(text)))
        yield pa.RecordBatch.from_pydict({"word": list(found), "n": pa.array(found.values(), pa.int64())})

    rows = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r["word"].encode(): r["n"] for r in rows}  # at most one row per template word
    return counts, counts.pop(b"", 0)


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, spans array<struct<label: string, start: long, share: double>>")


def scan(docs: DataFrame) -> DataFrame:
    """Per document: base counts, labels, score, and spans (label, first word, share) of the notices found."""
    index = Index(templates(), *frequencies(docs))
    base = {label: split_words(p) for label, p in BASE.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = defaultdict(list)
            for text in texts_of(b, 1):
                words = split_words(text)
                spans = index.find(words)
                hits = {label: places(words, p, index.anchor[label]) for label, p in base.items()} if spans else {}
                starts = [s for found in hits.values() for s in found]
                base_labels = sorted(label for label, found in hits.items() if found)
                out["n_words"].append(len(words))
                out["n_base"].append(len(starts))
                out["first_word"].append(min(starts, default=None))
                out["last_word"].append(max(starts, default=None))
                out["base_labels"].append(",".join(base_labels))
                out["labels"].append(",".join(sorted({*base_labels, *(s[0] for s in spans)})))
                out["score"].append(max((s[2] for s in spans), default=0.0))
                out["spans"].append([dict(zip(("label", "start", "share"), s)) for s in spans])
            types = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
                     "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
                     "spans": pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("share", pa.float64())]))}
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(out[k], t) for k, t in types.items())], names=["doc_id", *types])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(load(spark, sf_dir, "documents")).drop("spans")
