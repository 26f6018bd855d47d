"""Bars of calendar length (months, quarters, years), which have no fixed event-time window.

State is kept per symbol and calendar period; a timer at the period's end, in event time, gives the bar out once the
watermark (newest time less the delay) has passed it.  Ticks may come in any order before that.  A tick for a period
that is already out changes nothing and is counted in a row with ``late`` above 0.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "symbol string, open_time timestamp, open double, high double, low double, price double, volume double, late bigint"
STATE = "first bigint, open double, high double, low double, last bigint, price double, volume bigint"
UNITS = {"1M": ("month", 1), "3M": ("quarter", 3), "1y": ("year", 12)}


class PeriodProcessor(StatefulProcessor):
    """One bar: first and last tick by time, greatest and least price, number of ticks."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bar = handle.getValueState("bar", STATE)

    def handleInputRows(self, key, rows, timerValues):
        symbol, start, end = key
        closed, late = timerValues.getCurrentWatermarkInMs() >= end // 1000, 0
        bar = tuple(self.bar.get()) if self.bar.exists() else None
        fresh = bar is None
        for batch in rows:
            if closed:
                late += len(batch)
                continue
            ordered = batch.sort_values(["at", "price"])
            head, tail = ordered.iloc[0], ordered.iloc[-1]
            new = (int(head["at"]), float(head["price"]), float(batch["price"].max()), float(batch["price"].min()), int(tail["at"]), float(tail["price"]), len(batch))
            bar = new if bar is None else merged(bar, new)
        if not closed and bar is not None:
            self.bar.update(bar)
            if fresh:
                self.handle.registerTimer(end // 1000)
        yield _frame([(symbol, pd.Timestamp(start, unit="us"), None, None, None, None, None, late)] if late else [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        bar = tuple(self.bar.get()) if self.bar.exists() else None
        self.bar.clear()
        yield _frame([(key[0], pd.Timestamp(key[1], unit="us"), bar[1], bar[2], bar[3], bar[5], float(bar[6]), 0)] if bar else [])

    def close(self) -> None:
        pass


def merged(a: tuple, b: tuple) -> tuple:
    """The bar of two groups of ticks."""
    first, last = min(a[:2], b[:2]), max(a[4:6], b[4:6])
    return (*first, max(a[2], b[2]), min(a[3], b[3]), *last, a[6] + b[6])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["symbol", "open_time", "open", "high", "low", "price", "volume", "late"]
    numbers = {n: "float64" for n in names[2:7]}
    return pd.DataFrame(rows, columns=names).astype({"open_time": "datetime64[us]", "late": "int64", **numbers})


def calendar_bars(ticks: DataFrame, interval: str = "1M", delay: str = "1 day", time: str = "ts", price: str = "value", symbol: str = "symbol") -> DataFrame:
    """Bars of ``1M``, ``3M`` or ``1y`` from ticks.  Needs the RocksDB state store on the session."""
    unit, months = UNITS[interval]
    start = F.date_trunc(unit, F.col(time))
    # the event time itself does not go on, so that late ticks reach the processor and are counted
    told = ticks.filter(F.col(time).isNotNull() & F.col(price).isNotNull()).withWatermark(time, delay).select(
        F.col(symbol).alias("symbol"), F.unix_micros(start).alias("start"), F.unix_micros(start + F.make_ym_interval(F.lit(0), F.lit(months))).alias("end"),
        F.unix_micros(F.col(time)).alias("at"), F.col(price).cast("double").alias("price"))
    return told.groupBy("symbol", "start", "end").transformWithStateInPandas(PeriodProcessor(), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")
