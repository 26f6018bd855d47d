"""Feature preparation as fit and apply: the fit is a few small tables, the apply is one lazy plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from brambling.operators import encode
from brambling.operators.cleanse import cap_dict
from brambling.operators.lookup import sized
from brambling.session import exists, settle
from brambling.sources.tables import load_fit, save_fit


@dataclass(frozen=True)
class Recipe:
    """What a preparation does, in order: rules, codes, medians, scaling, 0/1 columns."""

    keep: tuple[str, ...]                       # keys and target, passed through unchanged
    target: str
    numeric: tuple[str, ...]                    # scaled columns, coded ones included
    categorical: tuple[str, ...] = ()           # turned into 0/1 columns
    ordinal: tuple[str, ...] = ()               # coded by rank of the mean target
    class_ratio: tuple[str, ...] = ()           # coded by positives per negative
    impute: tuple[str, ...] = ()                # median for missing values
    caps: dict = field(default_factory=dict)    # upper limits applied before everything else
    rules: Callable[[DataFrame], DataFrame] = lambda df: df

    def start(self, df: DataFrame) -> DataFrame:
        return self.rules(cap_dict(df, self.caps) if self.caps else df)

    @property
    def coded(self) -> list[tuple[str, str]]:
        return [(c, f"{c}_code") for c in self.ordinal] + [(c, f"{c}_ratio") for c in self.class_ratio]


@dataclass(frozen=True)
class Fitted:
    recipe: Recipe
    codes: dict[str, DataFrame]
    medians: dict[str, float]
    ranges: dict[str, tuple[float, float]]
    categories: dict[str, list]
    positions: DataFrame | None = None      # of columns with very many categories

    def filled(self, df: DataFrame) -> DataFrame:
        for column, name in self.recipe.coded:
            df = df.join(self.codes[name], column, "left")
        return encode.impute(df, self.medians)

    def apply(self, df: DataFrame) -> DataFrame:
        r = self.recipe
        scaled = encode.scale(self.filled(r.start(df)), self.ranges)
        if self.positions is None:
            return encode.dummies(scaled, self.categories, [*r.keep, *r.numeric])
        hot = encode.sparse_dummies(scaled, self.positions)      # one more column: where the ones of wide columns are
        return encode.dummies(hot, self.categories, [*r.keep, *r.numeric, "hot"])

    @property
    def features(self) -> list[str]:
        return [*self.recipe.numeric, *[f"{c}_{v}" for c, vs in self.categories.items() for v in vs[1:]]]

    def save(self, spark: SparkSession, path: str) -> None:
        """Parquet tables: codes, numbers, categories, and positions if there are any."""
        codes = None
        for name, table in self.codes.items():
            category, code = table.columns
            part = table.select(F.lit(name).alias("name"), F.col(category).cast("string").alias("category"),
                                F.col(code).cast("double").alias("code"))
            codes = part if codes is None else codes.unionByName(part)
        if codes is None:
            codes = spark.createDataFrame([], "name string, category string, code double")
        numbers = [(c, "median", float(v)) for c, v in self.medians.items()]
        numbers += [(c, m, float(v)) for c, pair in self.ranges.items() for m, v in zip(("low", "high"), pair)]
        kinds = [(c, i, str(v)) for c, vs in self.categories.items() for i, v in enumerate(vs)]
        save_fit(codes, f"{path}/codes")
        save_fit(spark.createDataFrame(numbers, "column string, measure string, value double"), f"{path}/numbers")
        save_fit(spark.createDataFrame(kinds, "column string, position int, value string"), f"{path}/categories")
        if self.positions is not None:
            save_fit(self.positions, f"{path}/positions")


def fit(recipe: Recipe, train: DataFrame) -> Fitted:
    start = settle(recipe.start(train))     # every fit step below reads this once-cleaned table
    codes = {f"{c}_code": encode.fit_ordinal(start, c, recipe.target, f"{c}_code") for c in recipe.ordinal}
    for c in recipe.class_ratio:
        codes[f"{c}_ratio"] = encode.fit_class_ratio(start, c, recipe.target).withColumnRenamed("ratio", f"{c}_ratio")
    codes = {name: sized(table) for name, table in codes.items()}
    coded = start
    for column, name in recipe.coded:
        coded = coded.join(codes[name], column, "left")
    medians = encode.fit_medians(coded, list(recipe.impute)) if recipe.impute else {}
    filled = encode.impute(coded, medians)
    return Fitted(recipe, codes, medians, encode.fit_ranges(filled, list(recipe.numeric)), *encode.fit_categories(filled, list(recipe.categorical)))


def load(spark: SparkSession, recipe: Recipe, path: str) -> Fitted:
    codes = load_fit(spark, f"{path}/codes")
    numbers = load_fit(spark, f"{path}/numbers").collect()     # a few rows per column
    kinds = load_fit(spark, f"{path}/categories").orderBy("column", "position").collect()
    value = {(r["column"], r["measure"]): r["value"] for r in numbers}
    tables = {name: codes.filter(F.col("name") == name).select(F.col("category").alias(c), F.col("code").alias(name))
              for c, name in recipe.coded}
    return Fitted(recipe, tables, {c: value[c, "median"] for c in recipe.impute},
                  {c: (value[c, "low"], value[c, "high"]) for c in recipe.numeric},
                  {c: [r["value"] for r in kinds if r["column"] == c] for c in recipe.categorical},
                  load_fit(spark, f"{path}/positions") if exists(spark, f"{path}/positions") else None)
