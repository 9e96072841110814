"""Helpers shared by the operators: word patterns, text digests, buckets with running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-cases A to Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(WORD), F.lit(0))


def bind(value: Column, body) -> Column:
    """``body`` of ``value``, with the value computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def hex_hash(*parts: Column) -> Column:
    """60 bits of the MD5 of the parts, joined by colons; the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def hex_hash_sql(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 15))::BIGINT"


#: Buckets per group for running totals: a window task holds one bucket of one group.
BUCKET_BITS = 12


def group_keys(group: str) -> list[Column]:
    """A nullable group column as two join keys that are never null."""
    return [F.coalesce(F.col(group).cast("string"), F.lit("")).alias("__group"), F.col(group).isNull().alias("__null")]


GROUP_KEYS = ["__group", "__null"]


def running(df: DataFrame, group: str, hash_col: str, value: str, name: str, narrow: DataFrame | None = None) -> DataFrame:
    """Adds the total of ``value`` over all earlier rows of the group, in order of a 60-bit hash.

    A group may hold any share of the rows: its rows are windowed bucket by bucket (a bucket is
    a range of the hash), and only the bucket totals, a number fixed by ``BUCKET_BITS``, meet in
    one window per group. ``narrow``: the same rows with the columns named here alone, if they
    are at hand in a cheaper form.
    """
    def bucketed(rows: DataFrame) -> DataFrame:
        return rows.select("*", *group_keys(group), F.shiftrightunsigned(F.col(hash_col), 60 - BUCKET_BITS).alias("__bucket"))

    totals = bucketed(narrow or df).groupBy(*GROUP_KEYS, "__bucket").agg(F.sum(value).alias("__total"))
    before = F.sum("__total").over(
        Window.partitionBy(*GROUP_KEYS).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(*GROUP_KEYS, "__bucket", F.coalesce(before, F.lit(0)).alias("__before"))
    within = F.sum(value).over(Window.partitionBy(*GROUP_KEYS, "__bucket").orderBy(hash_col)
                               .rowsBetween(Window.unboundedPreceding, -1))
    rows = bucketed(df).withColumn("__within", F.coalesce(within, F.lit(0)))
    return rows.join(totals, [*GROUP_KEYS, "__bucket"]).select(
        *df.columns, (F.col("__before") + F.col("__within")).alias(name))


#: A-Z to lower case, the other ASCII characters outside a-z and 0-9 to spaces; bytes from 0x80 stay.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 32 for c in range(256))


def split_words(text: str) -> list[bytes]:
    """Lower-cased runs of letters, digits and everything outside ASCII."""
    return text.encode().translate(FOLD).split()
