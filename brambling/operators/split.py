"""Deterministic train/test splits, samples and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brambling.functions import columns as C
from brambling.operators.ordering import number_rows, top_k, top_k_per_group


def hash_split(df: DataFrame, key: str, test_percent: int = 20, seed: int = 42) -> DataFrame:
    """Mark test rows by a hash of the key: the same row lands on the same side in every run."""
    return df.withColumn("is_test", C.hash_bucket(F.col(key), seed=seed) < test_percent)


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Mark the first share of each class in hash order as test."""
    hashed = df.withColumn("_h", C.hash_number(F.col(key), seed=seed))
    ranked = number_rows(hashed, ["_h", key], "_rank", [label])
    sizes = df.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    return (ranked.join(sizes, F.col(label).eqNullSafe(F.col("_label")), "left")
            .withColumn("is_test", F.col("_rank") <= F.floor(F.col("_n") * test_share))
            .drop("_h", "_rank", "_label", "_n"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by smallest hash; everything when there are fewer.

    Rows are counted in 65,536 ranges of the hash first, which tells below which hash the sample
    lies; only those rows are ordered.
    """
    hashed = df.withColumn("_h", C.hash_number(F.col(key), seed=seed))
    width = 1 << 16
    counts = hashed.groupBy(F.floor(F.col("_h") / width).alias("r")).agg(F.count(F.lit(1)).alias("n")).collect()
    seen, bound = 0, None
    for r, count in sorted((row["r"], row["n"]) for row in counts):
        seen += count
        if seen >= n:
            bound = (r + 1) * width
            break
    near = hashed if bound is None else hashed.filter(F.col("_h") < bound)
    return (near if bound is None else top_k(near, ["_h", key], n)).drop("_h")


def consecutive_folds(df: DataFrame, order: list[Column | str], k: int, name: str = "fold") -> DataFrame:
    """Fold number 0..k-1 over consecutive rows; the first ``rows % k`` folds hold one row more."""
    numbered = number_rows(df, order, "_rn")
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    small = F.floor(F.col("_n") / k)
    extra = F.col("_n") % k
    zero = F.col("_rn") - 1
    edge = extra * (small + 1)
    fold = F.when(zero < edge, F.floor(zero / (small + 1))).otherwise(
        extra + F.floor(F.try_divide(zero - edge, small)))
    return numbered.join(F.broadcast(total)).withColumn(name, fold.cast("bigint")).drop("_rn", "_n")


def position_slice(df: DataFrame, order: list[Column | str], start: int, stop: int | None = None) -> DataFrame:
    """Rows from position ``start`` up to, not including, ``stop`` (0-based)."""
    rows = number_rows(df, order, "_rn")
    keep = F.col("_rn") > start
    if stop is not None:
        keep = keep & (F.col("_rn") <= stop)
    return rows.filter(keep).drop("_rn")


def time_split(df: DataFrame, day: str, train_start: str, train_end: str, test_end: str) -> DataFrame:
    """Rows of the two ranges with ``part`` = train or test; boundaries move to business days and
    the test range starts the day after the training range."""
    bound = lambda text: C.business_day(F.lit(text).cast("date"))
    at = F.col(day)
    part = (F.when(at.between(bound(train_start), bound(train_end)), "train")
            .when((at > bound(train_end)) & (at <= bound(test_end)), "test"))
    return df.withColumn("part", part).filter(F.col("part").isNotNull())


def tail_context(df: DataFrame, by: str, order: str, n: int) -> DataFrame:
    """Last ``n`` rows per group in order."""
    return top_k_per_group(df, [by], [F.desc(order)], n, "_r").drop("_r")


def missing_categories(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    """Categories seen in training that the test rows do not have."""
    return train.select(column).distinct().exceptAll(test.select(column).distinct())
