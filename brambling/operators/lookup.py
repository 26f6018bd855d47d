"""Joins: keyed lookups in fitted tables, chained merges, aligned division, token membership."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from brambling.session import settle

def sized(df: DataFrame) -> DataFrame:
    """A lookup side whose size the planner knows.

    The (often aggregated) frame is computed once and written; a written table has an exact size,
    so it is broadcast below ``spark.sql.autoBroadcastJoinThreshold`` and shuffled beyond it.
    """
    return settle(df)


def lookup(df: DataFrame, params: DataFrame, key: str) -> DataFrame:
    """Left join to a fitted table on one key; an unseen key gives null."""
    return df.join(sized(params), key, "left")


def left_merge(base: DataFrame, others: list[DataFrame], on: str, fill: float = 0) -> DataFrame:
    """Chained left merges on one key, missing values filled."""
    merged = reduce(lambda left, right: left.join(right, on, "left"), others, base)
    added = [c for o in others for c in o.columns if c != on]
    return merged.fillna(fill, subset=added)


def dimension_join(facts: DataFrame, items: DataFrame, on: str) -> DataFrame:
    return facts.join(items, on, "left")


def align_divide(df: DataFrame, key: str, numerator: Column, denominator: Column, name: str = "ratio") -> DataFrame:
    """Count rows where each condition holds per key and divide; null when either side is absent."""
    top, bottom = F.count_if(numerator), F.count_if(denominator)
    return df.groupBy(key).agg(F.try_divide(F.nullif(top, F.lit(0)), F.nullif(bottom, F.lit(0))).alias(name))
