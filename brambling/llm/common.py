"""Helpers the corpus operators share: word patterns, intermediate tables, dealt-out tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brambling import session

WORD = r"[^\x20\x09-\x0D]+"   # a word: anything but the six ASCII white-space characters
SPACE = r"[\x20\x09-\x0D]+"


def settle(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the shared folder and go on from it.

    The shuffle files behind it are of no use any more, so Spark is told to remove them when the
    write ends; the setting is put back afterwards.
    """
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        return session.settle(df.select("*"))
    finally:
        spark.conf.set(key, before)


def discard(df: DataFrame) -> None:
    """Remove the files of a settled table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        if folder.getName().startswith("settled-"):
            folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def col(name: str) -> Column:
    """A top-level column by its exact name, also when the name holds a dot."""
    return F.col(f"`{name}`")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_tag() -> Column:
    """Tells equal rows apart in a sort, so that many copies of one row do not land in one range."""
    return F.monotonically_increasing_id()
