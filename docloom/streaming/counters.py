"""Running labelled counters over an event stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom import schemas

#: What is written before it is merged, as a share of the table it is merged into.
MERGE_AT = 1.0


class CounterTable:
    """A table of counts by label set: a base and the changes since, merged when these have grown as large.

    Every batch writes the label sets that it changed, with their new counts, and nothing else. A merge writes the other one of two
    versions and then points to it, so that a reader finds a whole version at any time; it also empties the changes of the version
    it wrote, so that one base stays behind. A batch that is run again writes the same changes over the old ones, or, if they are
    merged already, changes that nobody reads.
    """

    def __init__(self, spark: SparkSession, path: str, labels: list[str], schema: T.StructType) -> None:
        self.spark, self.path, self.labels, self.schema = spark, path, labels, schema

    def _read(self, folder: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def current(self) -> tuple[int, int]:
        """The version to read, and the last batch that is merged into it."""
        pointer = T.StructType().add("batch", "long")
        found = [(self._read(f"pointer-{side}", pointer).agg(F.max("batch")).first()[0], side) for side in (0, 1)]
        merged, side = max((-1 if batch is None else batch, side) for batch, side in found)
        return side, merged

    def base(self, side: int) -> DataFrame:
        return self._read(f"version-{side}/base", self.schema)

    def changes(self, side: int, merged: int) -> DataFrame:
        """Changed label sets of later batches, with the batch."""
        schema = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        return self._read(f"version-{side}/changes", schema).filter(F.col("batch") > merged)

    def table(self) -> DataFrame:
        side, merged = self.current()
        rows = self.base(side).withColumn("batch", F.lit(-1).cast("long")).unionByName(self.changes(side, merged))
        last = F.max(F.struct("batch", "value")).alias("last")
        return rows.groupBy(*self.labels).agg(last).select(*self.labels, "last.value")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        side, merged = self.current()
        if batch_id <= merged:
            return
        batch.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/version-{side}/changes/batch={batch_id}")
        if self.changes(side, merged).count() > MERGE_AT * self.base(side).count():
            self.merge(batch_id)

    def merge(self, batch_id: int) -> None:
        side, merged = self.current()
        other = 1 - side
        self.table().write.mode("overwrite").parquet(f"{self.path}/version-{other}/base")
        empty = self.spark.createDataFrame([], self.schema)
        empty.write.mode("overwrite").parquet(f"{self.path}/version-{other}/changes")
        self.spark.createDataFrame([(batch_id,)], "batch long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/pointer-{other}")
        # What the version before held is of no use any more.
        for part in ("base", "changes"):
            empty.write.mode("overwrite").parquet(f"{self.path}/version-{side}/{part}")


def running_counters(spark: SparkSession, source: str, pattern: str, target: str, checkpoint: str, *labels: str, files_per_batch: int = 1000) -> DataFrame:
    """Counts per label set; the state holds one row per label set, and a batch writes those that it changed."""
    events = (
        spark.readStream.schema(schemas.EVENT).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch).parquet(source)
    )
    counts = events.groupBy(*labels).agg(F.count(F.lit(1)).alias("value"))
    table = CounterTable(spark, target, list(labels), counts.schema)
    run = (
        counts.writeStream.outputMode("update").foreachBatch(table.write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return table.table()
