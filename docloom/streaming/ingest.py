"""Incremental ingest: every document key is stored once over all history."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import schemas
from docloom.session import materialise

TABLE = "celex_number string, title string, content string, file string"
#: Folders of a target, several times the keys of an ordinary batch; fixed for the life of a table.
BUCKETS = 1024


def _first_copies(batch: DataFrame, row: str) -> DataFrame:
    """Number of one row per key: the smallest (file, text digest), found by a combined minimum of digests and row numbers.

    Only these travel through the aggregation; texts are joined once, by the unique numbers of the rows that are kept, and
    a key that fills the batch costs one row per task. Equal copies inside one file have the same digest; any one of them stands for all.
    """
    tag = F.struct("file", F.md5("content").alias("digest"), row)
    return batch.select("celex_number", tag.alias("_tag")).groupBy("celex_number").agg(F.min("_tag").alias("_tag")).select(f"_tag.{row}")


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def stored_keys(spark: SparkSession, target: str, buckets: list[int]) -> DataFrame | None:
    """The keys of these folders, the only ones that are listed; none if no such folder is there."""
    try:
        return spark.read.schema("celex_number string").parquet(f"{target}/bucket={{{','.join(map(str, buckets))}}}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_unseen(target: str, buckets: int = BUCKETS):
    """Batch writer: drop the keys already stored, then append.

    The target is partitioned by a hash of the key. Only the folders that the batch's own keys fall into are listed, and only
    their key column is scanned, reduced to the keys of the batch: a semi-join, for which Spark broadcasts small key sets or filters the scan by a bloom
    filter.  So a batch costs what it brings, however long the history is, down to one folder.  A batch that is run
    again after a failure finds its keys stored and adds nothing, so no state grows outside
    the table itself.
    """

    def write(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn("bucket", bucket_of(F.col("celex_number"), buckets)).withColumn("_row", F.monotonically_increasing_id())
        rows = materialise(rows, "arrivals")  # numbers that are written stay the same in every use
        # At most as many numbers as there are folders.
        touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())
        if not touched:
            return
        known = stored_keys(batch.sparkSession, target, touched)
        unseen = rows
        if known is not None:
            hits = known.join(rows.select("celex_number").distinct(), "celex_number", "left_semi")
            unseen = rows.join(hits, "celex_number", "left_anti")
        # Written, so that the planner knows how few numbers they are: an ordinary batch's texts then stay where they are.
        first = materialise(_first_copies(unseen, "_row"), "first-copies")
        fresh = rows.join(first, "_row", "left_semi").select("celex_number", "title", "content", "file", "bucket")
        # One file a folder and batch, unless a folder gets most of it.
        fresh.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(target)

    return write


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 1000,
           buckets: int = BUCKETS) -> DataFrame:
    """Runs all files that have arrived below `source` into `target`; returns the target table."""
    stream = (
        spark.readStream.schema(schemas.DOCUMENT)
        .option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch)
        .json(source)
        .select("metadata.celex_number", "metadata.title", "content", F.col("_metadata.file_path").alias("file"))
        .filter(F.col("celex_number").isNotNull())
    )
    run = (
        stream.writeStream.foreachBatch(append_unseen(target, buckets))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    try:
        return spark.read.schema(TABLE).parquet(f"{target}/bucket=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], TABLE)
