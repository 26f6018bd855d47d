"""Grouped summaries, reports over columns, and pivots kept in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brambling.operators.ordering import quantiles_wide, top_k_per_group


def group_mean(df: DataFrame, keys: list[str], target: str, name: str = "mean") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(target).alias(name))


def group_max(df: DataFrame, key: str, score: str, name: str = "best") -> DataFrame:
    return df.groupBy(key).agg(F.max(score).alias(name))


def group_count(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_sum_pivot(df: DataFrame, row: str, column: str, levels: list[str], value: str) -> DataFrame:
    """Sum per row key and level; the levels are given, so no pass is spent to find them."""
    return df.groupBy(row).agg(*[
        F.sum(F.when(F.col(column) == level, F.col(value))).alias(str(level)) for level in levels])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return group_count(df, [column]).orderBy(F.desc("n"), column)


def share(df: DataFrame, column: str) -> DataFrame:
    """Percent of rows per class; the total is a one-row aggregate of the counts."""
    counts = group_count(df, [column])
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select(column, "n", (F.col("n") * 100.0 / F.col("total")).alias("percent"))


def unpivot(one_row: DataFrame, columns: list[str], measures: list[str]) -> DataFrame:
    """Turn columns named ``column__measure`` of a single row into one row per column."""
    cells = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{m}").alias(m) for m in measures]) for c in columns]
    return one_row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of distinct values per column, null counted as one value.

    Columns are melted and de-duplicated before they are counted, so one shuffle on
    (column, value) serves them all and no counting set is kept in memory.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return (df.select(F.explode(cells).alias("cell")).select("cell.*").distinct()
            .groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
            .orderBy(F.desc("n_distinct"), "column"))


def missing_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null count and percent per column from one pass."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"{c}__missing") for c in columns])
    row = row.withColumns({f"{c}__percent": F.col(f"{c}__missing") * 100.0 / F.col("_rows") for c in columns})
    return unpivot(row, columns, ["missing", "percent"]).orderBy(F.desc("percent"), "column")


def describe(df: DataFrame, numeric: list[str], text: list[str]) -> DataFrame:
    """Count, unique, top and frequency of text columns; moments and exact quartiles of numeric ones."""
    row = df.agg(*[f(F.col(c)).alias(f"{c}__{m}") for c in numeric for m, f in
                   (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))])
    moments = unpivot(row.select(*[F.col(c).cast("bigint" if c.endswith("__count") else "double").alias(c)
                                   for c in row.columns]), numeric, ["count", "mean", "std", "min", "max"])
    quartiles = quantiles_wide(df, numeric, {"q1": .25, "median": .5, "q3": .75})
    numbers = moments.join(quartiles, "column")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in text])
    counted = (df.select(F.explode(cells).alias("cell")).select("cell.*").filter(F.col("value").isNotNull())
               .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    words = counted.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"), F.max("n").alias("freq"))
    return numbers.unionByName(words, allowMissingColumns=True)


def pivot_mean(df: DataFrame, item: str, user: str, value: str, name: str = "value") -> DataFrame:
    """Mean of duplicates per (item, user); absent pairs stay absent instead of being filled with 0."""
    return df.groupBy(item, user).agg(F.avg(value).alias(name))


def row_mean(columns: list[Column]) -> Column:
    """Horizontal mean that skips nulls."""
    filled = [F.coalesce(c, F.lit(0.0)) for c in columns]
    present = [F.when(c.isNotNull(), 1).otherwise(0) for c in columns]
    return F.try_divide(sum(filled[1:], filled[0]), sum(present[1:], present[0]))


def mode_per_class(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """Most frequent cluster of each class, ties to the smallest, and the class a cluster stands for
    (the later class wins when two classes share a cluster)."""
    counts = group_count(df, [label, cluster])
    modes = counts.groupBy(label).agg(F.min_by(cluster, F.struct(-F.col("n"), F.col(cluster))).alias(cluster))
    owner = modes.groupBy(cluster).agg(F.max(label).alias("mapped_label"))
    return modes.join(owner, cluster).select(label, cluster, "mapped_label")


def term_frequency(df: DataFrame, cluster: str, terms: str, n: int) -> DataFrame:
    """Top terms per cluster from an array column of terms."""
    counts = group_count(df.select(cluster, F.explode(terms).alias("term")).filter(F.col("term") != ""), [cluster, "term"])
    return top_k_per_group(counts, [cluster], [F.desc("n"), F.col("term")], n)


def group_distribution(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers of each column per class."""
    quartiles = quantiles_wide(df, columns, {"q1": .25, "median": .5, "q3": .75}, [by])
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(by, F.explode(cells).alias("cell")).select(by, "cell.*")
    value = F.col("value")
    return (long.join(quartiles, [by, "column"])
            .groupBy(by, "column", "q1", "median", "q3")
            .agg(F.min(F.when(value >= F.col("q1") - spread, value)).alias("low_whisker"),
                 F.max(F.when(value <= F.col("q3") + spread, value)).alias("high_whisker")))


def score_and_count(df: DataFrame, key: str, criterion: str, score: str, criteria: int) -> DataFrame:
    """Best score and row count per key and criterion; total = mean score times mean count."""
    per = df.groupBy(key, criterion).agg(F.max(score).alias("score"), F.count(F.lit(1)).alias("n"))
    return (per.groupBy(key)
            .agg((F.sum("score") / criteria).alias("avg_sim"), (F.sum("n") / criteria).alias("avg_count"))
            .withColumn("total_score", F.col("avg_sim") * F.col("avg_count")))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"))
