"""Global and per-group order without a one-task sort.

Ranks, running sums and quantiles need a total order.  A window over a hot group (or over
no group at all) would pull that group into one task, so the order is established by a
range-partitioned sort, each row's place is written to the shared folder with the row, and
every range ("block") adds the totals of the blocks before it.  What crosses blocks is one row per block and group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from brambling.session import settle

_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row position in the low 33 bits


def sorted_blocks(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """Rows in total order; ``_block`` is the range a row fell into, ``_place`` its position there."""
    placed = df.orderBy(*order).withColumns({
        "_block": F.spark_partition_id(),
        "_place": F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)),
    })
    return settle(placed)


def running_sums(df: DataFrame, order: list[Column | str], sums: dict[str, Column],
                 by: list[str] | None = None) -> DataFrame:
    """Add inclusive running sums in ``order`` within each ``by`` group.

    ``order`` must be total inside a group for a reproducible result.
    """
    by = by or []
    blocks = sorted_blocks(df, [*by, *order])
    keys = ["_block", *by]
    inside = Window.partitionBy(*keys).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    local = blocks.withColumns({name: F.sum(e).over(inside) for name, e in sums.items()})
    totals = blocks.groupBy(*keys).agg(*[F.sum(e).alias(f"_t_{n}") for n, e in sums.items()])
    before = (Window.partitionBy(*(by or [F.lit(0)])).orderBy("_block")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in sums])
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))
    return (local.join(carry, on, "left")
            .select(*df.columns, *[(F.coalesce(F.col(n), F.lit(0)) + F.col(f"_c_{n}")).alias(n) for n in sums]))


def number_rows(df: DataFrame, order: list[Column | str], name: str = "row_id",
                by: list[str] | None = None) -> DataFrame:
    """1-based row number in ``order`` within each ``by`` group."""
    return (running_sums(df, order, {name: F.lit(1)}, by)
            .withColumn(name, F.col(name).cast("bigint")))


ACCURACY = 10_000


def _melted(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return (df.select(*by, F.explode(cells).alias("_cell")).select(*by, "_cell.column", "_cell.value")
            .filter(F.col("value").isNotNull()))


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys that may be null."""
    named = right.select(*[F.col(k).alias(f"_j_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys))
    return left.join(named, on).drop(*[f"_j_{k}" for k in keys])


def _between_ranks(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Quantiles from rows (keys, prob, value, _n, _below, _size): ``_n`` rows hold the value and
    ``_below`` rows come before the first value that is listed."""
    group = [*keys, "prob"]
    ranked = running_sums(counted, ["value"], {"_upto": F.col("_n")}, group)
    upto = F.col("_upto") + F.col("_below")        # a value covers the 0-based positions [upto - _n, upto)
    spot = (F.col("_size") - 1) * F.col("prob")
    lower, upper = F.floor(spot), F.ceil(spot)
    covers = lambda at: (at >= upto - F.col("_n")) & (at < upto)
    return (ranked.groupBy(*group)
            .agg(F.max(F.when(covers(lower), F.col("value"))).alias("_lo"),
                 F.max(F.when(covers(upper), F.col("value"))).alias("_hi"), F.max(spot - lower).alias("_w"))
            .select(*group, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_w")).alias("quantile")))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    by: list[str] | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """Exact linearly interpolated quantiles, one row per group, column and probability.

    A sketch with a guaranteed rank error brackets each quantile; one more pass counts the rows
    below the bracket and the values inside it, and only those (about 4 / accuracy of the rows,
    ties counted once) are ranked.  Nothing else is shuffled or sorted.  Should a bracket miss,
    all values are ranked instead.
    """
    by = by or []
    keys = [*by, "column"]
    long = _melted(df, columns, by)
    slack = 2.0 / accuracy
    asked = [min(1.0, max(0.0, p + d)) for p in probs for d in (-slack, slack)]
    sketch = F.percentile_approx("value", asked, accuracy)
    # groups no larger than the sketch's resolution are ranked whole
    edge = lambda i, open_: F.lit(None).cast("double") if open_ else F.when(F.col("_size") > accuracy, F.col("_cuts")[i])
    targets = F.array(*[F.struct(F.lit(float(p)).alias("prob"), edge(2 * i, p - slack <= 0).alias("lo"),
                                 edge(2 * i + 1, p + slack >= 1).alias("hi")) for i, p in enumerate(probs)])
    brackets = settle(long.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), sketch.alias("_cuts"))
                      .select(*keys, "_size", targets.alias("_targets")))
    met = _joined(long, brackets.select(*keys, "_targets"), keys)
    value = F.col("value")
    below = met.groupBy(*keys).agg(*[
        F.count_if(value < F.col("_targets")[i]["lo"]).alias(f"_b{i}") for i in range(len(probs))])
    edges = [(F.col("_targets")[i]["lo"], F.col("_targets")[i]["hi"]) for i in range(len(probs))]
    inside = [(lo.isNull() | (value >= lo)) & (hi.isNull() | (value <= hi)) for lo, hi in edges]
    picked = F.array_compact(F.array(*[F.when(c, F.lit(float(p))) for c, p in zip(inside, probs)]))
    counted = (met.filter(reduce(lambda a, b: a | b, inside)).select(*keys, "value", F.explode(picked).alias("prob"))
               .groupBy(*keys, "prob", "value").agg(F.count(F.lit(1)).alias("_n")))
    cells = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.col(f"_b{i}").alias("_below")) for i, p in enumerate(probs)]))
    offsets = below.select(*keys, cells.alias("_o")).select(*keys, "_o.prob", "_o._below")
    sizes = brackets.select(*keys, "_size")
    found = _between_ranks(_joined(_joined(counted, offsets, [*keys, "prob"]), sizes, keys), keys)
    out = settle(found)
    if out.filter(F.col("quantile").isNull()).isEmpty():
        return out
    return _ranked_quantiles(long, keys, probs)


def _ranked_quantiles(long: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Quantiles from a full ranking of the distinct values."""
    counted = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_n"))
    sizes = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    asked = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    every = _joined(counted, sizes, keys).withColumns({"prob": asked, "_below": F.lit(0)})
    return _between_ranks(every, keys)


def quantiles_wide(df: DataFrame, columns: list[str], named: dict[str, float],
                   by: list[str] | None = None) -> DataFrame:
    """``exact_quantiles`` with one output column per named probability."""
    by = by or []
    long = exact_quantiles(df, columns, list(named.values()), by)
    return long.groupBy(*by, "column").agg(*[
        F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("quantile"))).alias(n) for n, p in named.items()])


FEW = 1_000  # up to here every task keeps only its best rows (the optimizer's own limit for groups)


def top_k(df: DataFrame, order: list[Column | str], k: int) -> DataFrame:
    """First ``k`` rows in total ``order``.

    A small ``k`` is kept per task and merged; a large one would send k rows of every task to one
    place, so the rows are numbered by block instead.
    """
    if k <= FEW:
        return df.orderBy(*order).limit(k)
    return number_rows(df, order, "_top").filter(F.col("_top") <= k).drop("_top")


def top_k_per_group(df: DataFrame, by: list[str], order: list[Column | str], k: int,
                    rank: str = "rank") -> DataFrame:
    """First ``k`` rows of every group.

    For a small ``k`` the optimizer turns the filter on ``row_number`` into a limit per task before
    the shuffle (window group limit), so a hot group sends little; for a large one the group is
    numbered by block.
    """
    if k > FEW:
        return number_rows(df, order, rank, by).filter(F.col(rank) <= k)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w).cast("bigint")).filter(F.col(rank) <= k)
