"""A result table that a stream rewrites by key: a later row takes the place of the one before it.

The table is Parquet, partitioned by one column.  A micro-batch is merged by key into the partitions that it
touches, and only those are written again.  What a merge leads to is written to a staging folder of the batch's number
first, and from there over the partitions.  A batch that comes again after a failure is therefore harmless: if its
staging folder is whole, the partitions are written from it once more; else the merge is done again, on partitions
that nothing has changed.  Rows carry the number of the batch that last changed them.

Of several rows for a key the one with the greatest ``newest`` stays, of equally new ones the greatest by all columns,
so the order of batches and repeats make no difference.  A table takes its batches from one numbering (one stream's
checkpoint).  Rows with a null key are kept by their null key like any
other; a null in ``newest`` is oldest; the partition column must depend on the key alone.  Types are those of the
first batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from brambling.session import exists, new_path, remove

BATCH = "batch"


@dataclass(frozen=True)
class ReplacingTable:
    """``path`` of the table, its ``keys``, the column that tells the ``newest`` row, and the partition column ``part``."""
    path: str
    keys: tuple[str, ...]
    newest: str
    part: str
    staging: str

    @classmethod
    def new(cls, spark: SparkSession, keys: list[str], newest: str, part: str) -> "ReplacingTable":
        """A table in the shared folder."""
        return cls(new_path(spark, "replaced"), tuple(keys), newest, part, new_path(spark, "staging"))

    def _latest(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """One row per key; sums of partial maxima, so a key with most of the rows goes to no task whole."""
        others = [c for c in columns if c not in self.keys]
        best = F.max(F.struct(F.col(self.newest).alias("_newest"), F.struct(*others).alias("_row")))
        return rows.groupBy(*self.keys).agg(best.alias("_best")).select(*self.keys, "_best._row.*")

    def merge(self, batch: DataFrame, number: int) -> None:
        """Merge one batch; again with the same number, nothing changes."""
        spark = batch.sparkSession
        columns = batch.columns
        staged = f"{self.staging.rstrip('/')}/batch-{number}"
        if not exists(spark, f"{staged}/_SUCCESS"):
            fresh = self._latest(batch, columns).withColumn(BATCH, F.lit(number).cast("long"))
            if exists(spark, self.path):
                old = spark.read.schema(fresh.schema).parquet(self.path)
                touched = batch.select(self.part).distinct().collect()       # partitions of one batch
                values = [row[0] for row in touched if row[0] is not None]
                hit = F.col(self.part).isin(values) if values else F.lit(False)
                if len(values) < len(touched):
                    hit = hit | F.col(self.part).isNull()
                # a row that stays as it is keeps its batch: of equal rows the least number
                marked = old.filter(hit).unionByName(fresh).withColumn("_age", -F.col(BATCH))
                fresh = self._latest(marked, [*[c for c in columns], "_age"]).withColumn(BATCH, -F.col("_age")).select(*columns, BATCH)
            fresh.write.mode("overwrite").parquet(staged)
        rows = spark.read.parquet(staged)
        if rows.columns and not rows.isEmpty():
            (rows.repartition(self.part, F.pmod(F.xxhash64(*self.keys), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(self.part).parquet(self.path))
        remove(spark, f"{self.staging.rstrip('/')}/batch-{number - 1}")       # a batch is asked for again only until the next one

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        """The rows as they are now."""
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(self.path)


def store_replacing(stream: DataFrame, table: ReplacingTable, checkpoint: str, trigger: dict | None = None):
    """Merge a stream into the table batch by batch, taking what is there now (or at the given trigger)."""
    return (stream.writeStream.foreachBatch(table.merge).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
