"""Reading and writing tables (CSV, JSON, Parquet) and the stored fit parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


class Tables:
    """Attribute access to the Parquet tables of one folder: ``Tables(spark, root).orders``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out when a table comes in fewer pieces than there are cores.

    A file with one large row group is read by one task; heavy work per row (text) should not stay
    there.  A table in enough pieces is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line; any URI Spark can read, local or object store."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """JSON records, optionally in one sub-folder per value, so readers prune by it."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).json(path)


def append_results(df: DataFrame, path: str) -> None:
    """Grow a result log without rewriting what is there."""
    df.write.mode("append").parquet(path)


def save_fit(params: DataFrame, path: str) -> None:
    """Store a fitted parameter table."""
    params.write.mode("overwrite").parquet(path)


def load_fit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
