"""Price bars from stored exchange answers and daily prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The first six of the twelve positions of a stored bar; the close is called price.
BAR_FIELDS = ("open_time", "open", "high", "low", "price", "volume")


def read_bars(raw: DataFrame, start: str, end: str | None = None, kline: str = "kline") -> DataFrame:
    """Positional text bars to named columns, time from epoch milliseconds, bad numbers to null.

    Keeps ``start <= open_time < end``.  Whether any row is left is the caller's question
    (``require_rows``), because answering it costs a job.
    """
    k = F.col(kline)
    at = F.timestamp_millis(k[0].try_cast("bigint")).cast("timestamp_ntz")
    numbers = [k[i].try_cast("double").alias(name) for i, name in enumerate(BAR_FIELDS) if i]
    named = raw.select(*[c for c in raw.columns if c != kline], at.alias("open_time"), *numbers)
    keep = F.col("open_time") >= F.lit(start).cast("timestamp_ntz")
    if end is not None:
        keep = keep & (F.col("open_time") < F.lit(end).cast("timestamp_ntz"))
    return named.filter(keep)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")
    return df


def lookback_start(start: Column, observations: int, minutes_per_bar: int = 30) -> Column:
    """Start moved back far enough to hold the given number of bars."""
    return start - F.make_dt_interval(mins=F.lit(observations * minutes_per_bar))


def earliest_time(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(F.min("open_time").alias("earliest"))


def load_prices(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Prices with the time cut to its date; both ends belong to the range.

    The range is put on the time column itself, so it reaches the scan.
    """
    after = F.col(time) >= F.lit(start).cast("timestamp_ntz")
    before = F.col(time) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
    return df.filter(after & before).withColumn("date", F.to_date(time))
