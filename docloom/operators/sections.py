"""Tables of documents and their ordered sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T

PART = 64


def _ordered(order: str, value: str) -> Column:
    rows = F.sort_array(F.collect_list(F.struct(F.col(order), F.col(value).alias("v"))))
    return F.transform(rows, lambda r: r["v"])


def assemble(sections: DataFrame, key: str, order: str, content: str, glue: str = "\n\n") -> DataFrame:
    """Document text from its sections in order.

    Runs of sections are joined first, each in its own group, and the runs are joined after, so
    that sorting never sees more than PART sections, and a long document is built from parts.
    """
    part = F.floor(F.col(order) / PART).alias("_part")
    runs = sections.filter(F.col(content).isNotNull()).groupBy(key, part).agg(
        F.array_join(_ordered(order, content), glue).alias("_text"))
    return runs.groupBy(key).agg(F.array_join(_ordered("_part", "_text"), glue).alias("text"))


def total_words(documents: DataFrame, sections: DataFrame, key: str) -> DataFrame:
    """Sum of section words per document; null without sections."""
    sums = sections.groupBy(key).agg(F.sum("word_count").alias("total_words"))
    return documents.join(sums, key, "left")


def type_counts(sections: DataFrame, key: str, kind: str) -> DataFrame:
    return sections.groupBy(key, kind).agg(F.count(F.lit(1)).alias("n_sections"))


def backfill_word_counts(sections: DataFrame, content: str) -> DataFrame:
    """Missing word counts are computed, present ones kept; the column is added when absent."""
    counted = T.word_count(F.col(content))
    if "word_count" not in sections.columns:
        return sections.withColumn("word_count", counted)
    return sections.withColumn("word_count", F.coalesce(F.col("word_count"), counted))


def nested(sections: DataFrame, key: str, order: str) -> DataFrame:
    """One row per document with its sections as an ordered array of structs."""
    item = F.struct("title", "content", F.col("section_type").alias("type"))
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("s"))))
    return sections.groupBy(key).agg(F.transform(rows, lambda r: r["s"]).alias("sections"))


def processed_tables(docs: DataFrame, sections: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(documents, sections) ready to be stored; documents without sections are left out."""
    counted = backfill_word_counts(sections, "content")
    sums = counted.groupBy(key).agg(F.sum("word_count").alias("total_words"))
    return docs.join(sums, key), counted
