"""Row and schema cleansing."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, functions as F

from brambling.functions import columns as C
from brambling.operators.ordering import number_rows


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def select_features(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*names)


def filter_positive(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target) > 0)


def filter_in(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def filter_entity_cluster(df: DataFrame, entity: str, entity_value, cluster: str, cluster_value) -> DataFrame:
    return df.filter((F.col(entity) == entity_value) & (F.col(cluster) == cluster_value))


def cast_schema(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast declared columns; text that is no number becomes null, a fraction is cut off."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop rows equal in every column."""
    return df.dropDuplicates()


def null_tokens(df: DataFrame, columns: list[str], token: str = "?") -> DataFrame:
    return df.withColumns({c: C.null_token(F.col(c), token) for c in columns})


def cap_dict(df: DataFrame, caps: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: C.clamp_top(F.col(c), t) for c, t in caps.items()})


def number_texts(df: DataFrame, text: str, key: str, name: str = "row_id") -> DataFrame:
    """Running number in order of a unique key, and lower-cased text; rows without text are dropped first.

    Only the keys are sorted; the texts meet their numbers in one join.
    """
    kept = df.filter(F.col(text).isNotNull())
    return kept.withColumn(text, F.lower(text)).join(number_rows(kept.select(key), [key], name), key)
