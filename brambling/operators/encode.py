"""Feature preparation: each fit is an aggregate that yields a small table, each apply a projection or a lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brambling.operators.lookup import align_divide, lookup
from brambling.operators.ordering import number_rows, quantiles_wide
from brambling.session import settle


def apply_lookup(df: DataFrame, fit: DataFrame, key: str) -> DataFrame:
    return lookup(df, fit, key)


def fit_class_ratio(df: DataFrame, category: str, target: str) -> DataFrame:
    """Positives per negative of each category."""
    return align_divide(df, category, F.col(target) == 1, F.col(target) == 0)


def fit_ordinal(df: DataFrame, category: str, target: str, name: str = "code") -> DataFrame:
    """Categories ranked from 0 by ascending mean target."""
    means = df.groupBy(category).agg(F.avg(target).alias("_mean")).filter(F.col(category).isNotNull())
    return number_rows(means, ["_mean", category], name).select(category, (F.col(name) - 1).alias(name))


def fit_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact medians; one row per column reaches the driver."""
    rows = quantiles_wide(df, columns, {"median": .5}).collect()
    return {row["column"]: row["median"] for row in rows}


def impute(df: DataFrame, fill: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def fit_ranges(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[f(c).alias(f"{c}__{n}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: (row[f"{c}__lo"], row[f"{c}__hi"]) for c in columns}


def minmax(col: Column, low: float, high: float) -> Column:
    """(x - min) / (max - min); a constant column gives 0."""
    span = high - low
    return (col - F.lit(low)) / F.lit(span if span else 1.0)


def scale(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: minmax(F.col(c), float(lo), float(hi)) for c, (lo, hi) in ranges.items()})


def unscale(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: F.col(c) * F.lit(float(hi - lo) or 1.0) + F.lit(float(lo)) for c, (lo, hi) in ranges.items()})


WIDE = 10_000       # a column with more categories than this is encoded by position


def fit_categories(df: DataFrame, columns: list[str], limit: int = WIDE) -> tuple[dict[str, list], DataFrame | None]:
    """Sorted categories of each column that has at most ``limit``, and the positions of those of all other columns.

    Few categories become columns of their own; many stay a table (``fit_positions``), however many there are.
    """
    few, many = {}, []
    for c in columns:
        rows = df.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(c).limit(limit + 1).collect()
        if len(rows) > limit:
            many.append(c)
        else:
            few[c] = [row[0] for row in rows]
    return few, fit_positions(df, many) if many else None


def fit_positions(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, position): 0/1 places of all categories but each column's first, by column and value, from 0.

    The table is numbered by sorted blocks and never collected.
    """
    cells = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for k, c in enumerate(columns)])
    found = df.select(F.explode(cells).alias("c")).select("c.*").filter(F.col("value").isNotNull()).distinct()
    later = number_rows(found, ["value"], "nth", ["k"]).filter(F.col("nth") > 1).select("k", "column", "value")
    return settle(number_rows(later, ["k", "value"], "position").select("column", "value", (F.col("position") - 1).alias("position")))


def sparse_dummies(df: DataFrame, positions: DataFrame, name: str = "hot") -> DataFrame:
    """``df`` with the ascending positions of each row's ones; a null, a first category or one not seen in the fit has none."""
    columns = [row[0] for row in positions.select("column").distinct().orderBy("column").collect()]
    out = df
    for k, c in enumerate(columns):
        part = positions.filter(F.col("column") == c).select(F.col("value").alias(f"_v{k}"), F.col("position").alias(f"_p{k}"))
        out = out.join(part, F.col(c).cast("string") == F.col(f"_v{k}"), "left")
    hot = F.array_sort(F.array_compact(F.array(*[F.col(f"_p{k}") for k in range(len(columns))])))
    return out.select(*df.columns, hot.alias(name))


def hot_vector(df: DataFrame, width: int, name: str = "hot", to: str = "features") -> DataFrame:
    """The positions as a sparse vector of ``width`` places, for Spark's models."""
    from pyspark.ml.linalg import SparseVector, VectorUDT
    vector = F.udf(lambda at: None if at is None else SparseVector(width, [int(i) for i in at], [1.0] * len(at)), VectorUDT())
    return df.withColumn(to, vector(name))


def dummies(df: DataFrame, categories: dict[str, list], keep: list[str]) -> DataFrame:
    """One 0/1 column per category but the first; categories of the fit only, null gives all 0."""
    made = [F.when(F.col(c) == v, 1).otherwise(0).alias(f"{c}_{v}")
            for c, values in categories.items() for v in values[1:]]
    return df.select(*keep, *made)


def index_ids(df: DataFrame, column: str, name: str = "index") -> DataFrame:
    """Distinct ids with a dense 0-based index."""
    ids = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return number_rows(ids, [column], name).withColumn(name, F.col(name) - 1)
