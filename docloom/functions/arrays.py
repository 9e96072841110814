"""Helpers for array work inside one row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hold(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are evaluated exactly once per row.

    The optimiser may inline a projected expression into a lambda, which then runs it once per
    array element.  A generator between the two projections keeps them apart.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Binds a value to a name inside an expression, so that the body evaluates it once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pack_starts(sizes: Column, limit: Column | int) -> Column:
    """0-based start of every group when sizes are packed greedily in order.

    A group closes when the next size would take it over the limit; an oversize item stands
    alone.  The fold carries numbers only and appends once per group.
    """
    limit = F.lit(limit) if isinstance(limit, int) else limit
    empty = F.struct(
        F.array().cast("array<int>").alias("starts"), F.lit(0).cast("long").alias("size"), F.lit(0).alias("i"))

    def step(acc, n):
        fresh = (acc["i"] == 0) | (acc["size"] + n > limit)
        return F.struct(
            F.when(fresh, F.concat(acc["starts"], F.array(acc["i"]))).otherwise(acc["starts"]).alias("starts"),
            F.when(fresh, n.cast("long")).otherwise(acc["size"] + n).alias("size"),
            (acc["i"] + 1).alias("i"),
        )

    return F.aggregate(F.transform(sizes, lambda n: n.cast("long")), empty, step, lambda acc: acc["starts"])


def groups(items: Column, starts: Column, glue: str) -> Column:
    """The packed items joined group by group; items and starts must be plain references."""
    end = lambda k: F.coalesce(F.get(starts, k + 1), F.size(items))
    return F.transform(
        starts, lambda s, k: F.array_join(F.slice(items, s + 1, end(k) - s), glue))


def pack(items: Column, sizes: Callable[[Column], Column], limit: Column | int, glue: str) -> Column:
    """Greedy packing of text items into joined texts, for use inside larger expressions."""
    return let(items, lambda it: let(
        pack_starts(F.transform(it, sizes), limit), lambda st: groups(it, st, glue)))


#: Bytes of text that are Python objects at a time, each element counted with what the object adds.
SLICE, OBJECT = 1 << 20, 64


def text_slices(texts: pa.Array) -> Iterator[pa.Array]:
    """An array of texts in order, in slices whose Python objects are small however large the batch is; a longer text stands alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + OBJECT)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE, side="right")))
        yield texts.slice(lo, hi - lo)
        lo = hi


def of_each(fn: Callable[[pd.Series], pd.Series], kind: str) -> Callable[[Column], Column]:
    """A Python function of many texts as a column function of arrays of texts: a number (long or double) for each, in its row.

    A null array gives an empty one. Elements must not be null.
    """
    types = {"long": (pa.int64(), np.int64), "double": (pa.float64(), np.float64)}[kind]

    def run(texts: pa.Array) -> pa.Array:
        counts = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
        values = np.concatenate([np.empty(0, types[1]), *[np.asarray(fn(part.to_pandas()), types[1]) for part in text_slices(texts.flatten())]])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values, types[0]))

    return F.arrow_udf(run, f"array<{kind}>")
