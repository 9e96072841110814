"""JSON document store: partitioned by year, month and journal, with committed versions.

``year=/month=/journal_id=/commit=<id>`` holds what one upsert wrote to a partition; it is never changed again.
``_manifest/version=<n>`` lists for every partition the commit that holds it, in one file, so that it is there or not.
Readers follow the greatest version; an upsert that dies before it publishes one leaves the store as it was. One writer at a time.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import schemas
from docloom.session import by_key, materialise

PARTITIONS = ["year", "month", "journal_id"]
STORED = T.StructType([
    T.StructField("doc_id", T.StringType()),
    *schemas.DOCUMENT.fields,
])
CORRUPT = "_corrupt_record"
#: Share of the rows of a batch up to which those of repeated keys are taken out and put together apart.
FEW = 0.01
MANIFEST = f"{', '.join(f'{p} string' for p in PARTITIONS)}, commit string, version long"
#: A partition (year, month, journal; nulls as they are) and the commit that holds it.
Entries = dict[tuple[str | None, ...], str]


def _entries(spark: SparkSession, path: str) -> tuple[int, Entries | None]:
    """The last published version and its partitions, whose number bounds what the driver holds; none for a folder without versions."""
    try:
        manifests = spark.read.schema(MANIFEST).json(f"{path}/_manifest")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0, None
        raise
    last = manifests.agg(F.max("version")).first()[0]
    if last is None:
        return 0, None
    rows = manifests.filter(F.col("version") == last).collect()
    return last, {tuple(r[p] for p in PARTITIONS): r["commit"] for r in rows if r["commit"] is not None}


def _place(*columns: str) -> Column:
    """Partition columns as one text that is never null."""
    return F.concat_ws("\x01", *[F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in columns])


def _folder(place: tuple[str | None, ...], commit: str) -> str:
    """Where the writer puts a partition of a commit."""
    # The characters that are spelt by their code in a folder's name, and the name of null.
    spelt = lambda v: re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", v)
    name = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None else spelt(v)
    return "/".join(f"{c}={name(v)}" for c, v in zip((*PARTITIONS, "commit"), (*place, commit)))


def _partitioned(spark: SparkSession, path: str, entries: Entries, schema: T.StructType = STORED) -> DataFrame:
    """The documents of these partitions: only their folders are listed and read."""
    full = T.StructType([*schema.fields, *[T.StructField(p, T.StringType()) for p in (*PARTITIONS, "commit")]])
    if not entries:
        return spark.createDataFrame([], full)
    return (
        spark.read.schema(full).option("basePath", path).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).json([f"{path}/{_folder(p, c)}" for p, c in entries.items()])
    )


def scan_tree(spark: SparkSession, path: str) -> DataFrame:
    """Every readable document below a folder with its path; unreadable or keyless ones are skipped.

    A folder written by ``store`` is read at its last version, any other one whole.
    """
    schema = T.StructType([*STORED.fields, T.StructField(CORRUPT, T.StringType())])
    _, entries = _entries(spark, path)
    if entries is None:
        df = (
            spark.read.schema(schema)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.json")
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(path)
        )
    else:
        df = _partitioned(spark, path, entries, schema)
    df = df.select(*schema.fieldNames(), F.col("_metadata.file_path").alias("path"))
    return df.filter(F.col(CORRUPT).isNull() & F.col("metadata.celex_number").isNotNull()).drop(CORRUPT)


def write_single_files(docs: DataFrame, key: str, path: str) -> None:
    """One file per key, all in one folder: a folder per file would take most of the time to write and to list.

    The key spreads the files over the tasks and is not written. Of rows with equal keys one is kept.
    """
    by_key(docs, key).dropDuplicates([key]).drop(key).write.option("maxRecordsPerFile", 1).json(path)


def scan_single_files(spark: SparkSession, path: str) -> DataFrame:
    """The same for a tree of pretty-printed files, one document each."""
    schema = T.StructType([*schemas.DOCUMENT.fields, T.StructField(CORRUPT, T.StringType())])
    df = (
        spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
        .option("multiLine", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).json(path)
        .withColumn("path", F.col("_metadata.file_path"))
    )
    return df.filter(F.col(CORRUPT).isNull() & F.col("metadata.celex_number").isNotNull()).drop(CORRUPT)


def with_partitions(df: DataFrame, date: Column, journal: Column) -> DataFrame:
    return df.withColumn("year", F.date_format(date, "yyyy")).withColumn(
        "month", F.date_format(date, "MM")).withColumn("journal_id", journal)


def one_per_key(rows: DataFrame) -> DataFrame:
    """The row of the greatest hash of its content where a batch brings a key more than once."""
    rest = [c for c in rows.columns if c not in ("doc_id", *PARTITIONS)]
    last = F.max_by(F.struct(*rest), F.xxhash64(F.to_json(F.struct(*rest)))).alias("last")
    return rows.groupBy("doc_id", *PARTITIONS).agg(last).select("doc_id", *PARTITIONS, "last.*").select(*rows.columns)


def one_per_key_of_written(rows: DataFrame) -> DataFrame:
    """The same of rows that are in files: their keys are counted alone, and where few come more than once, only rows of these are shuffled."""
    keys = ["doc_id", *PARTITIONS]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    again = F.col("n") > 1
    total, repeats = counts.agg(F.sum("n"), F.sum(F.when(again, F.col("n")).otherwise(0))).first()
    if not repeats:
        return rows
    if repeats > FEW * total:
        return one_per_key(rows)
    repeated = materialise(counts.filter(again).select(F.col("doc_id").alias("_key"), _place(*PARTITIONS).alias("_place")), "repeated")
    same = F.col("doc_id").eqNullSafe(F.col("_key")) & (_place(*PARTITIONS) == F.col("_place"))
    return rows.join(repeated, same, "left_anti").unionByName(one_per_key(rows.join(repeated, same, "left_semi")))


def publish(spark: SparkSession, path: str, version: int, entries: Entries) -> None:
    """Makes a version the one that readers see: one file, which is there or not."""
    rows = [(*place, commit, version) for place, commit in entries.items()] or [(None,) * (len(PARTITIONS) + 1) + (version,)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(f"{path}/_manifest/version={version:012d}")


def store(docs: DataFrame, path: str, written: bool = False) -> None:
    """Upsert by (partition, doc_id): a stored document is replaced, its neighbours stay, and
    a key that comes twice in the batch is stored once.

    The batch is written out first, unless it is read from files that stay (``written``). So its partitions are known, and only
    those are read; they are written anew, with what
    stays of them, to a commit of their own, and published at the end. The rebalance
    hint lets adaptive execution split a partition that received most of the rows.
    """
    spark = docs.sparkSession
    batch = docs.select(*STORED.fieldNames(), *PARTITIONS)
    batch = batch if written else materialise(one_per_key(batch), "upsert")
    rows = one_per_key_of_written(batch) if written else batch
    touched = [tuple(r) for r in batch.select(*PARTITIONS).distinct().collect()]
    version, entries = _entries(spark, path)
    held = {p: entries[p] for p in touched if p in entries} if entries else {}
    if held:
        keys = batch.select(F.col("doc_id").alias("_key"), _place(*PARTITIONS).alias("_place"))
        same = F.col("doc_id").eqNullSafe(F.col("_key")) & (_place(*PARTITIONS) == F.col("_place"))
        kept = _partitioned(spark, path, held).join(keys, same, "left_anti")
        rows = rows.unionByName(kept.select(*rows.columns))
    commit = uuid.uuid4().hex
    rows = rows.withColumn("commit", F.lit(commit)).hint("rebalance", *PARTITIONS)
    rows.write.mode("append").option("compression", "gzip").partitionBy(*PARTITIONS, "commit").json(path)
    publish(spark, path, version + 1, {**(entries or {}), **{p: commit for p in touched}})


def lookup(spark: SparkSession, path: str, year: str, month: str, journal: str, doc_id: str) -> DataFrame:
    """Point lookup: the version names the one folder that can hold it."""
    place = (year, month, journal)
    _, entries = _entries(spark, path)
    return _partitioned(spark, path, {place: entries[place]} if entries and place in entries else {}).drop("commit").filter(F.col("doc_id") == doc_id)


def existing(keys: DataFrame, stored: DataFrame, *on: str) -> DataFrame:
    return keys.join(stored.select(*on), list(on), "left_semi")
