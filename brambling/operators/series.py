"""Time series per key, cut into position blocks so that no series has to fit one task.

``positioned`` numbers the rows of each series.  Rolling functions run per (series, block):
each block borrows the last rows of the block before it.  Cumulative functions add one
carried row per block.  Blocks hold ``block_rows`` rows, so a hot series spreads out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from brambling.operators.ordering import number_rows

BLOCK_ROWS = 65_536


@dataclass(frozen=True)
class Blocks:
    """Names that identify a series and the block size."""

    keys: tuple[str, ...] = ("symbol",)
    time: str = "open_time"
    rows: int = BLOCK_ROWS

    @property
    def by(self) -> list[str]:
        return [*self.keys, "blk"]

    @property
    def order(self) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy("pos")

    @property
    def upto(self) -> WindowSpec:
        return self.order.rowsBetween(Window.unboundedPreceding, 0)

    @property
    def earlier(self) -> WindowSpec:
        """All blocks before this one, over one-row-per-block frames."""
        return Window.partitionBy(*self.keys).orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)

    def with_keys(self, *extra: str) -> "Blocks":
        return Blocks(self.keys + extra, self.time, self.rows)


def positioned(df: DataFrame, b: Blocks) -> DataFrame:
    """Add ``pos`` (1-based in time order within the series) and its block ``blk``."""
    numbered = number_rows(df, [b.time], "pos", list(b.keys))
    return numbered.withColumn("blk", F.floor((F.col("pos") - 1) / b.rows))


def rolling(df: DataFrame, b: Blocks, lookback: int, *steps: Callable[[WindowSpec], dict[str, Column]]) -> DataFrame:
    """Add window columns that look at most ``lookback`` rows back, in one shuffle.

    Each step maps the window to new columns and may use columns of the steps before it.  A row goes to its own
    block and to those after it that hold a row it is at most ``lookback`` rows before.
    """
    furthest = F.floor((F.col("pos") - 1 + lookback) / b.rows)
    spread = df.withColumn("_own", F.col("blk")).withColumn("blk", F.explode(F.sequence(F.col("blk"), furthest)))
    for step in steps:
        spread = spread.withColumns(step(b.order))
    return spread.filter(F.col("blk") == F.col("_own")).drop("_own")


def cumulative(df: DataFrame, b: Blocks, sums: dict[str, Column], keep_null: bool = True) -> DataFrame:
    """Add running sums along each series; a null term leaves null on its row only."""
    totals = df.groupBy(*b.by).agg(*[F.sum(e).alias(f"_t_{n}") for n, e in sums.items()])
    carry = totals.select(*b.by, *[F.coalesce(F.sum(f"_t_{n}").over(b.earlier), F.lit(0.0)).alias(f"_c_{n}") for n in sums])
    joined = df.join(carry, b.by, "left")
    made = {}
    for n, e in sums.items():
        value = F.coalesce(F.sum(e).over(b.upto), F.lit(0.0)) + F.col(f"_c_{n}")
        made[n] = F.when(e.isNotNull(), value) if keep_null else value
    return joined.withColumns(made).drop(*[f"_c_{n}" for n in sums])


def last_value(df: DataFrame, b: Blocks, value: Column, name: str) -> DataFrame:
    """Add the latest non-null ``value`` up to each row (``name``) and up to the row before (``name_prev``)."""
    closing = df.groupBy(*b.by).agg(F.max_by(F.when(value.isNotNull(), value),
                                             F.when(value.isNotNull(), F.col("pos"))).alias("_close"))
    carry = closing.select(*b.by, F.last("_close", ignorenulls=True).over(b.earlier).alias("_carry"))
    here = F.last(value, ignorenulls=True)
    return (df.join(carry, b.by, "left")
            .withColumns({name: F.coalesce(here.over(b.upto), F.col("_carry")),
                          f"{name}_prev": F.coalesce(
                              here.over(b.order.rowsBetween(Window.unboundedPreceding, -1)), F.col("_carry"))})
            .drop("_carry"))


# --- indicator columns -------------------------------------------------------------------------

def sma(price: Column, n: int, w: WindowSpec) -> Column:
    """Mean of the last n values, null until n values exist."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(price).over(frame) == n, F.avg(price).over(frame))


def log_return(price: Column, w: WindowSpec) -> Column:
    return F.ln(F.try_divide(price, F.lag(price).over(w)))


def lag_values(value: Column, n: int, w: WindowSpec) -> Column:
    """The n values before each row as an array, null until there are n."""
    held = F.collect_list(value).over(w.rowsBetween(-n, -1))
    return F.when(F.size(held) == n, held)


def cross_direction(short: Column, long: Column, ties_flat: bool = False) -> Column:
    """+1 while the short mean is above the long one, else -1; with ``ties_flat`` ties and nulls give 0."""
    up = F.when(short > long, 1)
    return up.when(short < long, -1).otherwise(0) if ties_flat else up.otherwise(-1)


def crossover_event(direction: Column, w: WindowSpec) -> Column:
    step = direction - F.lag(direction).over(w)
    return F.when(step == 2, 1).when(step == -2, -1).otherwise(0)


# --- relative strength -------------------------------------------------------------------------

def relative_strength(df: DataFrame, b: Blocks, change: Column, period: Column, first: Column) -> DataFrame:
    """Add ``rsi`` and ``rsi_prev`` (Wilder's averages) to rows with ``pos`` and ``blk``.

    ``first`` is the position of the first valid change.  The average starts as the mean of the
    first ``period`` changes and is then updated as (old * (n - 1) + new) / n.  An update is
    linear in the old average, so each block is summed up by one number per average; those are
    decayed into the start value of the later blocks, and blocks are then worked independently.
    """
    n = period.cast("double")
    seed_at = first + period - 1
    rows = df.withColumns({"_n": n, "_seed": seed_at.cast("bigint"),
                           "_gain": F.coalesce(F.greatest(change, F.lit(0.0)), F.lit(0.0)),
                           "_loss": F.coalesce(F.greatest(-change, F.lit(0.0)), F.lit(0.0))})
    decay = (F.col("_n") - 1) / F.col("_n")
    ends = ((F.col("blk") + 1) * b.rows).alias("_end")
    weighed = rows.select(*b.by, "pos", "_n", "_seed", "_gain", "_loss", ends)
    power = F.pow(decay, F.greatest(F.lit(0), F.col("_end") - F.greatest("pos", "_seed")).cast("double")) / F.col("_n")
    sums = weighed.groupBy(*b.by, "_n", "_seed", "_end").agg(
        F.sum(F.col("_gain") * power).alias("_g"), F.sum(F.col("_loss") * power).alias("_l"))
    carried = T.StructType([*[f for f in sums.schema.fields if f.name in b.by], T.StructField("_g0", T.DoubleType()), T.StructField("_l0", T.DoubleType())])
    starts = sums.groupBy(*b.keys).applyInPandas(_carry_averages(b), carried)
    fields = [f for f in df.schema.fields if f.name not in ("rsi", "rsi_prev")]
    schema = T.StructType([*fields, T.StructField("rsi", T.DoubleType()), T.StructField("rsi_prev", T.DoubleType())])
    return rows.join(starts, b.by).groupBy(*b.by).applyInPandas(_rsi_block, schema)


def _carry_averages(b: Blocks) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Start values of a series' blocks from their summaries, one row per block: each block decays what came
    before it by its own number of updates and adds its own part, however long the period is."""
    rows, columns = b.rows, [*b.by, "_g0", "_l0"]

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("blk", ignore_index=True)
        gain, loss, out = 0.0, 0.0, []
        for n, seed, end, g, l in pdf[["_n", "_seed", "_end", "_g", "_l"]].itertuples(index=False):
            out.append((gain, loss))
            kept = ((n - 1) / n) ** max(0, end - max(end - rows, seed))
            gain, loss = gain * kept + g, loss * kept + l
        pdf[["_g0", "_l0"]] = out
        return pdf[columns]

    return walk


def _average(values: pd.Series, pos: pd.Series, start: float, n: float, seed: int) -> pd.Series:
    """Averages at the block's rows, with the value before the first row in front."""
    warm = int((pos <= seed).sum())
    out = [start]
    for v in values.iloc[:warm]:
        out.append(out[-1] + v / n)
    tail = pd.concat([pd.Series([out[-1]]), values.iloc[warm:]], ignore_index=True)
    smooth = tail.ewm(alpha=1.0 / n, adjust=False).mean()
    return pd.concat([pd.Series(out[:-1], dtype="float64"), smooth], ignore_index=True)


def _rsi_block(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("pos", ignore_index=True)
    n, seed = float(pdf["_n"].iloc[0]), int(pdf["_seed"].iloc[0])
    gain = _average(pdf["_gain"], pdf["pos"], float(pdf["_g0"].iloc[0]), n, seed)
    loss = _average(pdf["_loss"], pdf["pos"], float(pdf["_l0"].iloc[0]), n, seed)
    strength = 100.0 * gain / (gain + loss).where(lambda s: s != 0)
    pdf["rsi"] = strength.iloc[1:].reset_index(drop=True).where(pdf["pos"] >= seed)
    pdf["rsi_prev"] = strength.iloc[:-1].reset_index(drop=True).where(pdf["pos"] > seed)
    return pdf.drop(columns=["_n", "_seed", "_gain", "_loss", "_g0", "_l0"])


def smoothed_rsi(df: DataFrame, b: Blocks, sma_n: int, rsi_n: int, price: str = "price") -> DataFrame:
    """Relative strength of the smoothed price; adds ``sma``, ``ret``, ``rsi``, ``rsi_prev``, ``rsi_ratio``.

    Bars without a price have no place in the recurrence and are left out.
    """
    placed = positioned(df.filter(F.col(price).isNotNull()), b)
    p = F.col(price)
    rolled = rolling(placed, b, sma_n + 1,
                     lambda w: {"sma": sma(p, sma_n, w), "ret": log_return(p, w)},
                     lambda w: {"_change": F.col("sma") - F.lag("sma").over(w)})
    with_rsi = relative_strength(rolled, b, F.col("_change"), F.lit(rsi_n), F.lit(sma_n + 1)).drop("_change")
    return with_rsi.withColumn("rsi_ratio", F.try_divide(F.col("rsi"), F.nullif(F.col("rsi_prev"), F.lit(0.0))))
