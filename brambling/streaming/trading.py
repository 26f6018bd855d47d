"""Rolling indicators and the position on live bars, kept as keyed state."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from brambling.operators.strategy import Rules, step

OUTPUT = ("symbol string, open_time timestamp, price double, sma double, rsi double, rsi_ratio double, signal string, "
          "position int, strategy string, late boolean")
STATE = ("prices array<double>, sma double, changes bigint, gain double, loss double, rsi double, position int, waiting int, "
         "paid double, last_time timestamp")

#: The series of an end message: it moves the watermark behind every bar and gives no row itself.
END, END_TIME = "#end", 253_370_764_800_000     # 9999-01-01 in milliseconds

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class Bar:
    """The state of one series after its latest bar."""

    def __init__(self, rules: Rules, state: tuple | None = None):
        self.rules = rules
        (self.prices, self.sma, self.changes, self.gain, self.loss, self.rsi, self.position, self.waiting, self.paid,
         self.last_time) = state or ([], None, 0, 0.0, 0.0, None, rules.start, 0, rules.start_price, None)
        self.prices = list(self.prices)

    def as_state(self) -> tuple:
        return (self.prices, self.sma, self.changes, self.gain, self.loss, self.rsi, self.position, self.waiting, self.paid,
                self.last_time)

    def _strength(self) -> float | None:
        total = self.gain + self.loss
        return 100.0 * self.gain / total if total else None

    def advance(self, at, price: float) -> tuple:
        """Take one bar in: (sma, rsi, ratio, signal, position, event)."""
        r, before = self.rules, self.rsi
        self.prices = (self.prices + [price])[-r.sma_n:]
        previous, self.sma = self.sma, sum(self.prices) / r.sma_n if len(self.prices) == r.sma_n else None
        if previous is not None:
            change = self.sma - previous
            up, down = max(change, 0.0), max(-change, 0.0)
            self.changes += 1
            if self.changes <= r.rsi_n:
                self.gain, self.loss = self.gain + up / r.rsi_n, self.loss + down / r.rsi_n
            else:
                self.gain = (self.gain * (r.rsi_n - 1) + up) / r.rsi_n
                self.loss = (self.loss * (r.rsi_n - 1) + down) / r.rsi_n
            self.rsi = self._strength() if self.changes >= r.rsi_n else None
        rsi = self.rsi
        ratio = rsi / before if rsi is not None and before else None
        signal = None
        if rsi is not None:
            if rsi > r.high and (r.fall is None or (ratio is not None and ratio < r.fall)):
                signal = "SELL"
            if rsi < r.low and (r.rise is None or (ratio is not None and ratio > r.rise)):
                signal = "BUY"
        (self.position, self.waiting, self.paid), event = step((self.position, self.waiting, self.paid), price, rsi, ratio, signal, r)
        self.last_time = at
        return self.sma, rsi, ratio, signal, self.position, event


class TradingProcessor(StatefulProcessor):
    """Holds the bars of each series until the watermark has passed them, then advances bar by bar in time order.

    Files and rows may come in any order within the watermark's delay.  Of several messages for a bar that is still
    held the newest counts; a message for a bar that is already behind the series' last one changes nothing and is
    given out as a row with ``late`` set, so that it can be counted.  After an end message nothing is held any more.

    A series has one list of held bars, appended to once a micro-batch, and one timer, set to its earliest held bar.
    When the timer fires, the list is read once, everything behind the watermark is advanced, and the rest is
    written back, one row a bar.
    """

    def __init__(self, rules: Rules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("bar", STATE)
        self.held = handle.getListState("held", "at bigint, price double, seen bigint")
        self.armed = handle.getValueState("armed", "at bigint")

    def _bar(self) -> Bar:
        return Bar(self.rules, tuple(self.state.get()) if self.state.exists() else None)

    def _arm(self, at: int) -> None:
        """Move the timer to a bar that comes before the one it is set to."""
        set_to = self.armed.get()[0] if self.armed.exists() else None
        if set_to is not None:
            if set_to <= at:
                return
            self.handle.deleteTimer(set_to // 1000)
        self.handle.registerTimer(at // 1000)
        self.armed.update((at,))

    def handleInputRows(self, key, rows, timerValues):
        if key[0] == END:
            for _ in rows:
                pass
            yield _frame([])
            return
        last = self._bar().last_time
        done = None if last is None else pd.Timestamp(last).tz_localize(None).value // 1000
        came, late = [], []
        for batch in rows:
            for at, price, seen in zip(batch["at"].tolist(), batch["price"].tolist(), batch["seen"].tolist()):
                (late if done is not None and at <= done else came).append((at, price, seen))
        if came:
            came = newest(came)
            self.held.appendList(came)
            self._arm(came[0][0])
        yield _frame([(key[0], pd.Timestamp(at, unit="us"), price, None, None, None, None, None, None, True) for at, price, _ in late])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        held = newest([tuple(row) for row in self.held.get()])
        ready, rest = [h for h in held if h[0] <= reached], [h for h in held if h[0] > reached]
        self.armed.clear()
        if rest:
            self.held.put(rest)
            self._arm(rest[0][0])
        else:
            self.held.clear()
        out = []
        if ready:
            bar = self._bar()
            for at, price, _ in ready:
                time = pd.Timestamp(at, unit="us")
                out.append((key[0], time, price, *bar.advance(time.to_pydatetime(), price), False))
            self.state.update(bar.as_state())
        yield _frame(out)

    def close(self) -> None:
        pass


def newest(messages: list[tuple]) -> list[tuple]:
    """One (bar, price, seen) for each bar in time order: the newest message, of equally new ones the last."""
    kept: dict[int, tuple] = {}
    for message in messages:
        if message[0] not in kept or kept[message[0]][2] <= message[2]:
            kept[message[0]] = message
    return sorted(kept.values())


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["symbol", "open_time", "price", "sma", "rsi", "rsi_ratio", "signal", "position", "strategy", "late"])
    return frame.astype({"open_time": "datetime64[us]", "price": "float64", "sma": "float64", "rsi": "float64", "rsi_ratio": "float64",
                         "position": "Int32", "late": "bool"})


def live_positions(bars: DataFrame, rules: Rules, delay: str = "2 hours") -> DataFrame:
    """Indicators, signal and carried position per complete bar, once the watermark (newest event time less ``delay``) has passed it.

    What is still held when the input ends comes out with an end message (``end_message``) in the input.
    The time of the watermark itself does not go on, so that late messages reach the processor instead of being
    dropped.  Needs the RocksDB state store (``ROCKSDB``) on the session.
    """
    held = bars.filter((F.col("price").isNotNull() & F.col("open_time").isNotNull()) | (F.col("symbol") == END)).withWatermark("event_time", delay).select(
        "symbol", F.coalesce(F.unix_micros("open_time"), F.lit(0)).alias("at"), "price", F.unix_micros("event_time").alias("seen"))
    return (held.groupBy("symbol")
            .transformWithStateInPandas(TradingProcessor(rules), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime"))


def end_message() -> str:
    """The message a feed leaves last, once no more bars follow."""
    return json.dumps({"s": END, "E": END_TIME, "k": {"x": True}})
