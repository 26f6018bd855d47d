"""Statistics for data exploration, each from one or two aggregate passes."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from brambling.operators.aggregate import unpivot
from brambling.operators.ordering import quantiles_wide, running_sums


def melt(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """One row per cell: ``column``, ``value`` (double, null cells dropped)."""
    keep = keep or []
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return (df.select(*keep, F.explode(cells).alias("_cell")).select(*keep, "_cell.column", "_cell.value")
            .filter(F.col("value").isNotNull()))


def _each(df: DataFrame, columns: list[str], measures: dict) -> DataFrame:
    row = df.agg(*[make(F.col(c)).alias(f"{c}__{m}") for c in columns for m, make in measures.items()])
    return unpivot(row, columns, list(measures))


def shape_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis of each column."""
    out = _each(df, columns, {"n": lambda c: F.count(c).cast("double"), "g1": F.skewness, "g2": F.kurtosis})
    n = F.col("n")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, ((n + 1) * F.col("g2") + 6) * (n - 1) / ((n - 2) * (n - 3)))
    return out.select("column", skew.alias("skewness"), kurt.alias("kurtosis"))


def histogram(df: DataFrame, columns: list[str], bins: int = 30) -> DataFrame:
    """Counts of equal-width bins between the smallest and the largest value of each column."""
    ranges = _each(df, columns, {"lo": lambda c: F.min(c).cast("double"), "hi": lambda c: F.max(c).cast("double")})
    width = (F.col("hi") - F.col("lo")) / bins
    bin_ = F.when(width == 0, 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("lo")) / width)))
    # one range row per column name
    return (melt(df, columns).join(F.broadcast(ranges), "column")
            .groupBy("column", bin_.cast("bigint").alias("bin"), (F.col("lo") + bin_ * width).alias("left"))
            .agg(F.count(F.lit(1)).alias("n")))


def normal_bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean plus and minus three standard deviations, with the rows outside each side."""
    stats = _each(df, columns, {"mean": F.avg, "std": F.stddev_samp})
    bounds = stats.select("column", (F.col("mean") - 3 * F.col("std")).alias("lower"), (F.col("mean") + 3 * F.col("std")).alias("upper"))
    return _outside(df, columns, bounds)


def iqr_bounds(df: DataFrame, columns: list[str], distance: float = 1.5) -> DataFrame:
    """Quartiles minus and plus ``distance`` times their distance, with the rows outside each side."""
    q = quantiles_wide(df, columns, {"q1": .25, "q3": .75})
    reach = (F.col("q3") - F.col("q1")) * distance
    return _outside(df, columns, q.select("column", (F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper")))


def _outside(df: DataFrame, columns: list[str], bounds: DataFrame) -> DataFrame:
    rows = df.agg(F.count(F.lit(1)).alias("_rows"))
    out = (melt(df, columns).join(F.broadcast(bounds), "column").groupBy("column", "lower", "upper")
           .agg(F.count_if(F.col("value") > F.col("upper")).alias("above"),
                F.count_if(F.col("value") < F.col("lower")).alias("below")).join(F.broadcast(rows)))
    return out.select("column", "lower", "upper", "above", "below",
                      (F.col("above") / F.col("_rows")).alias("above_share"), (F.col("below") / F.col("_rows")).alias("below_share"))


def boxplot_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles, whiskers within 1.5 IQR and the number of outliers of each column."""
    q = quantiles_wide(df, columns, {"q1": .25, "median": .5, "q3": .75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    v = F.col("value")
    inside = v.between(F.col("q1") - reach, F.col("q3") + reach)
    return (melt(df, columns).join(F.broadcast(q), "column").groupBy("column", "q1", "median", "q3")
            .agg(F.min(F.when(inside, v)).alias("low_whisker"), F.max(F.when(inside, v)).alias("high_whisker"),
                 F.count_if(~inside).alias("outliers")))


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of each unordered pair over the rows where both are present, in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    row = df.agg(*[F.corr(F.when(both(a, b), F.col(a)).cast("double"), F.when(both(a, b), F.col(b)).cast("double"))
                   .alias(f"{a}__{b}") for a, b in pairs])
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("r")) for a, b in pairs])
    return row.select(F.explode(cells).alias("cell")).select("cell.*")


def target_corr(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    m = corr_matrix(df, [target, *columns]).filter(F.col("a") == target)
    return m.select(F.col("b").alias("column"), "r").orderBy(F.desc("r"))


def normal_quantile(p: Column) -> Column:
    """Inverse of the normal distribution by Acklam's published rational approximation (error below 1.2e-9)."""
    # The published coefficients.
    a = (-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239)
    b = (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572)
    c = (-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783)
    d = (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416)

    def poly(coefficients, x):
        out = F.lit(coefficients[0])
        for k in coefficients[1:]:
            out = out * x + k
        return out

    tail = F.sqrt(-2 * F.ln(F.least(p, 1 - p)))
    outer = poly(c, tail) / poly((*d, 1.0), tail)
    q = p - 0.5
    middle = poly(a, q * q) * q / poly((*b, 1.0), q * q)
    return F.when(p < 0.02425, outer).when(p > 1 - 0.02425, -outer).otherwise(middle)


def qq_points(df: DataFrame, column: str, id_column: str) -> DataFrame:
    """Each value with the normal quantile of its rank (plotting position (i - 0.5) / n)."""
    values = df.select(id_column, F.col(column).cast("double").alias("value")).filter(F.col("value").isNotNull())
    ranked = running_sums(values, ["value", id_column], {"_i": F.lit(1)})
    total = values.agg(F.count(F.lit(1)).alias("_n"))
    return (ranked.join(F.broadcast(total))
            .select(id_column, normal_quantile((F.col("_i") - 0.5) / F.col("_n")).alias("theoretical"), "value"))


def grid_points(df: DataFrame, x: str, y: str, weight: str, dx: float, dy: float, below: float | None = None) -> DataFrame:
    """A scatter chart as a grid: rows and mean weight per cell, with the weight limited first."""
    kept = df if below is None else df.filter(F.col(weight) < below)
    return (kept.groupBy(F.floor(F.col(x) / dx).alias("gx"), F.floor(F.col(y) / dy).alias("gy"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(weight).alias("weight")))


def vif(df: DataFrame, columns: list[str]) -> DataFrame:
    """Variance inflation factors without a constant, from one pass for the cross products."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    whole = df.na.drop(subset=columns)
    row = whole.agg(*[F.sum(F.col(columns[i]).cast("double") * F.col(columns[j])).alias(f"g{i}_{j}") for i, j in pairs]).first()
    gram = np.zeros((len(columns),) * 2)
    for i, j in pairs:
        gram[i, j] = gram[j, i] = row[f"g{i}_{j}"]
    size = np.sqrt(np.diag(gram))
    factors = np.diag(np.linalg.inv(gram / np.outer(size, size)))
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(columns, factors)], "column string, vif double")


def residuals(df: DataFrame, y: str, predicted: str) -> DataFrame:
    return df.withColumn("residual", F.col(y) - F.col(predicted))


def density(df: DataFrame, by: str, column: str, points: int = 64, bins: int = 1024) -> DataFrame:
    """Gaussian kernel density per class on a grid (Scott's bandwidth of the class).

    Rows are counted in fine bins first; the kernel then runs over classes x bins x points, which
    does not grow with the rows.
    """
    v = F.col(column).cast("double")
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    if lo is None:
        return df.select(by).limit(0).withColumns({"x": F.lit(0.0), "density": F.lit(0.0)})
    step = (hi - lo) / bins or 1.0
    stats = df.groupBy(by).agg(F.count(v).alias("_n"), F.stddev_samp(v).alias("_sd"))
    binned = (df.filter(v.isNotNull()).groupBy(by, F.least(F.lit(bins - 1), F.floor((v - lo) / step)).alias("_bin"))
              .agg(F.count(F.lit(1)).alias("_c")))
    grid = F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.lit(lo) + i * ((hi - lo) / (points - 1))))
    width = F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(step) * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    u = (F.col("x") - (lo + (F.col("_bin") + 0.5) * step)) / F.col("_h")
    return (binned.join(stats, by).withColumn("_h", width).withColumn("x", grid)
            .groupBy(by, "x").agg(F.sum(F.col("_c") * F.exp(-u * u / 2) / (F.col("_h") * math.sqrt(2 * math.pi) * F.col("_n"))).alias("density")))


def explained_variance(ratios: list[float], share: float = 0.95) -> tuple[list[float], int]:
    """Running share of the components and the number of components that reaches ``share``."""
    running = np.cumsum(ratios)
    reached = np.nonzero(running >= share - 1e-12)[0]
    return running.tolist(), int(reached[0]) + 1 if len(reached) else len(ratios)
