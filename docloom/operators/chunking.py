"""Splitting texts into bounded pieces; row-local, no shuffle."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions import text as T
from docloom.functions.arrays import groups, hold, let, of_each, pack

TokenCounter = Callable[[Column], Column]
# Private-use characters: what is set before each header, and the spelling of both in a text.
MARK, ESCAPE = "\ue000", "\ue001"


def sentence_chunks(text: Column, limit: int = K.CHUNK_WORDS) -> Column:
    """Sentences packed in order to at most `limit` words; an oversize sentence stands alone."""
    return pack(T.sentences(text), T.word_count, limit, " ")


def _non_empty(parts: Column) -> Column:
    return F.filter(F.transform(parts, T.strip), lambda p: p != "")


def _replace(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _by_header(pattern: str) -> Callable[[Column], Column]:
    """Pieces that each begin with their header; a text may hold the mark itself."""
    escape = lambda p: _replace(p, (ESCAPE, ESCAPE + "1"), (MARK, ESCAPE + "0"))
    restore = lambda p: _replace(p, (ESCAPE + "0", MARK), (ESCAPE + "1", ESCAPE))
    return lambda p: _non_empty(F.transform(
        F.split(F.regexp_replace(escape(p), f"({pattern})", MARK + "$1"), MARK, -1), restore))


def _by_paragraph(limit: int, count: TokenCounter) -> Callable[[Column], Column]:
    return lambda p: pack(_non_empty(F.split(p, K.BLANK_LINE, -1)), count, limit, "\n\n")


def _by_sentence(limit: int, count: TokenCounter) -> Callable[[Column], Column]:
    """Sentences packed in order; a sentence over the limit opens a new chunk and goes in word by
    word, and what follows is packed behind its last words."""

    def items(p):
        return F.flatten(F.transform(T.sentences(p), lambda s: let(count(s), lambda n: F.when(
            n <= limit, F.array(F.struct(s.alias("t"), n.alias("n"), F.lit(False).alias("fresh")))
        ).otherwise(F.transform(
            T.words(s), lambda w, i: F.struct(w.alias("t"), count(w).alias("n"), (i == 0).alias("fresh")))))))

    def starts(it):
        empty = F.struct(F.array().cast("array<int>").alias("starts"),
                         F.lit(0).cast("long").alias("size"), F.lit(0).alias("i"))

        def step(acc, x):
            fresh = (acc["i"] == 0) | x["fresh"] | (acc["size"] + x["n"] > limit)
            return F.struct(
                F.when(fresh, F.concat(acc["starts"], F.array(acc["i"]))).otherwise(acc["starts"]).alias("starts"),
                F.when(fresh, x["n"].cast("long")).otherwise(acc["size"] + x["n"]).alias("size"),
                (acc["i"] + 1).alias("i"))

        return F.aggregate(it, empty, step, lambda acc: acc["starts"])

    def joined(it):
        return let(starts(it), lambda st: F.transform(st, lambda s, k: F.array_join(
            F.slice(it["t"], s + 1, F.coalesce(F.get(st, k + 1), F.size(it)) - s), " ")))

    return lambda p: let(items(p), joined)


def structure_chunks(text: Column, limit: int = K.MAX_TOKENS, count: TokenCounter = T.word_count) -> Column:
    """Pieces of at most `limit` tokens along the structure of the text.

    A text that fits is one chunk.  Otherwise it is cut at headers of the first kind; a piece
    that is still too long at headers of the second and third kind, then at blank lines, then
    at sentences, then at words.  Each level touches only the pieces that are too long.
    """
    levels = [_by_header(p) for p in K.HEADER_PATTERNS]
    levels += [_by_paragraph(limit, count), _by_sentence(limit, count)]
    pieces = F.when(F.coalesce(F.length(text), F.lit(0)) > 0, F.array(text)).otherwise(
        F.array().cast("array<string>"))
    for level in levels:
        pieces = F.flatten(F.transform(pieces, _too_long(limit, count, level)))
    return pieces


def _too_long(limit: int, count: TokenCounter, split: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda p: F.when(count(p) <= limit, F.array(p)).otherwise(split(p))


# --- any counter ---------------------------------------------------------------------------------

#: Adds a column of token counts, one for each of an array of texts. Called with the frame, the column of texts and the new name.
ArrayCounter = Callable[[DataFrame, str, str], DataFrame]


def count_by_expression(count: TokenCounter = T.word_count) -> ArrayCounter:
    return lambda df, texts, name: df.withColumn(name, F.transform(texts, count))


def count_by_batches(count: Callable[[pd.Series], pd.Series]) -> ArrayCounter:
    """Counts by a Python function of many texts at once, a tokenizer for instance."""
    each = of_each(count, "long")
    return lambda df, texts, name: df.withColumn(name, each(F.col(texts)))


def _packed(items: Column, limit: int, glue: str) -> Column:
    """Items struct<t, n, owner, fresh> in order to joined texts: a chunk ends with its owner, before a fresh item, or when full."""
    empty = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).cast("long").alias("size"), F.lit(0).alias("i"), F.lit(-1).alias("owner"))

    def step(acc, x):
        fresh = (acc["owner"] != x["owner"]) | x["fresh"] | (acc["size"] + x["n"] > limit)
        return F.struct(
            F.when(fresh, F.concat(acc["starts"], F.array(acc["i"]))).otherwise(acc["starts"]).alias("starts"),
            F.when(fresh, x["n"]).otherwise(acc["size"] + x["n"]).alias("size"), (acc["i"] + 1).alias("i"), x["owner"].alias("owner"))

    return let(items, lambda it: let(F.aggregate(it, empty, step, lambda acc: acc["starts"]), lambda st: groups(it["t"], st, glue)))


def structure_chunks_by(df: DataFrame, text: str, name: str, counter: ArrayCounter, limit: int = K.MAX_TOKENS) -> DataFrame:
    """Adds the chunks of ``structure_chunks`` by any counter, a Python one included.

    The cascade goes level by level over arrays of pieces inside the row. Between levels the pieces are counted
    together, so a tokenizer gets them in batches; each level cuts only those that are too long.
    """
    def counted(df: DataFrame) -> DataFrame:
        return hold(counter(df, "_p", "_c"), _n=F.col("_c")).drop("_c")

    def zipped(*more: Column) -> Column:
        return F.arrays_zip(F.col("_p").alias("t"), F.col("_n").alias("n"), *more)

    whole = F.when(F.coalesce(F.length(text), F.lit(0)) > 0, F.array(F.col(text))).otherwise(F.array().cast("array<string>"))
    df = counted(hold(df, _p=whole))
    for split in map(_by_header, K.HEADER_PATTERNS):
        pieces = F.flatten(F.transform(zipped(), lambda x: F.when(x["n"] <= limit, F.array(x["t"])).otherwise(split(x["t"]))))  # noqa: B023
        df = counted(hold(df, _q=pieces).drop("_p", "_n").withColumnRenamed("_q", "_p"))

    def parts(cut: Callable[[Column], Column], fresh: Callable[[Column], Column]) -> Column:
        """What each piece that is too long is cut to, the others as they are, with the number of their piece."""
        return F.flatten(F.transform(zipped(F.col("_f").alias("f"), F.col("_o").alias("o")), lambda x: F.when(x["n"] <= limit, F.array(F.struct(
            x["t"].alias("t"), x["o"].alias("o"), x["f"].alias("f")))).otherwise(F.transform(
                cut(x["t"]), lambda t, k: F.struct(t.alias("t"), x["o"].alias("o"), fresh(k).alias("f"))))))

    def cut_into(df: DataFrame, cut: Callable[[Column], Column], fresh: Callable[[Column], Column]) -> DataFrame:
        df = hold(df, _i=parts(cut, fresh)).drop("_p", "_n", "_f", "_o")
        return counted(df.withColumns({"_p": F.col("_i.t"), "_o": F.col("_i.o"), "_f": F.col("_i.f")}).drop("_i"))

    def owned(df: DataFrame) -> DataFrame:
        """Every piece its own owner."""
        return df.withColumns({"_o": F.transform("_p", lambda _, i: i), "_f": F.transform("_p", lambda _: F.lit(False))})

    def joined(df: DataFrame, glue: str) -> DataFrame:
        items = F.transform(zipped(F.col("_f").alias("f"), F.col("_o").alias("o")), lambda x: F.struct(
            x["t"].alias("t"), x["n"].alias("n"), x["o"].alias("owner"), x["f"].alias("fresh")))
        return hold(df, _q=_packed(items, limit, glue)).drop("_p", "_n", "_o", "_f").withColumnRenamed("_q", "_p")

    never = lambda k: F.lit(False)
    df = joined(cut_into(owned(df), lambda t: _non_empty(F.split(t, K.BLANK_LINE, -1)), never), "\n\n")
    # A sentence that is too long opens a new chunk and goes in word by word.
    df = cut_into(owned(counted(df)), T.sentences, never)
    df = joined(cut_into(df, T.words, lambda k: k == 0), " ")
    return df.withColumnRenamed("_p", name)
