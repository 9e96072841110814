"""The corpus pipeline: quality rules, near-duplicates, benchmark leaks, source mix, token files.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's documents. All but the last return
the columns that came in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.llm.decontamination import decontaminate
from docloom.llm.mixture import mix
from docloom.llm.near_copies import first_of_each
from docloom.llm.quality import good_documents
from docloom.llm.simhash import one_of_each
from docloom.llm.token_files import default_tokenizer, token_files
from docloom.session import materialise
from docloom.sources.tables import load


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio (operator 6)."""
    return good_documents(docs, load(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (operator 7), then of each set of near copies (five-word similarity of 0.8 or more)."""
    return first_of_each(materialise(one_of_each(docs), "simhash-groups"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 8)."""
    return decontaminate(docs, load(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them (operator 1)."""
    return mix(docs).drop("mix_shard", "mix_place")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what is read back from them per document (operator 5)."""
    return token_files(docs, default_tokenizer())


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", near_duplicates), ("benchmark decontamination", benchmark_leaks),
          ("mixing sources", source_mix), ("token files", tokens)]

#: SQL cannot express XXH64 buckets, SimHash or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
