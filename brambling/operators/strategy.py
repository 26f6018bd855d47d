"""Signals, positions and returns of the relative-strength strategies."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from brambling.operators import series as S
from brambling.operators.ordering import running_sums
from brambling.operators.series import Blocks
from brambling.session import settle

RE_ENTRY_RSI = 40.0  # fixed value: strength above which a cut position is opened again


@dataclass(frozen=True)
class Rules:
    """Thresholds of one strategy run."""

    sma_n: int = 5
    rsi_n: int = 6
    low: float = 30.0
    high: float = 70.0
    rise: float | None = None      # a buy needs a ratio above this
    fall: float | None = None      # a sell needs a ratio below this
    cut_loss: float | None = None  # percent below the buy price that closes a position
    follow_trend: bool = False     # buy again while strength is high and rising
    start: int = 0                 # position before the first bar
    start_price: float | None = None

    def __post_init__(self):
        if self.follow_trend and self.cut_loss is None:
            raise ValueError("follow_trend needs cut_loss: without it no rule changes the position")
        if self.start == 1 and self.cut_loss is not None and self.start_price is None:
            raise ValueError("a long start with cut_loss needs the start price")


def indicator(rsi: Column, low: float, high: float) -> Column:
    return F.when(rsi < low, 1).when(rsi > high, 0)


def signal(rsi: Column, ratio: Column, r: Rules) -> Column:
    sell = rsi > r.high if r.fall is None else (rsi > r.high) & (ratio < r.fall)
    buy = rsi < r.low if r.rise is None else (rsi < r.low) & (ratio > r.rise)
    return F.when(buy, "BUY").when(sell, "SELL")


def with_signals(df: DataFrame, r: Rules) -> DataFrame:
    return df.withColumns({"indicator": indicator(F.col("rsi"), r.low, r.high),
                           "signal": signal(F.col("rsi"), F.col("rsi_ratio"), r)})


def simple_position(df: DataFrame, b: Blocks, start: int = 0) -> DataFrame:
    """Long after a BUY, flat after a SELL; only a row that changes the state carries an event."""
    held = F.when(F.col("signal") == "BUY", 1).when(F.col("signal") == "SELL", 0)
    out = S.last_value(df, b, held, "_held")
    now, before = F.coalesce("_held", F.lit(start)), F.coalesce("_held_prev", F.lit(start))
    event = F.when(now > before, "BUY").when(now < before, "SELL")
    return out.withColumns({"position": now, "strategy": event}).drop("_held", "_held_prev")


# --- the path-dependent strategies ---------------------------------------------------------------
# A state is (position, waiting, paid).  ``paid`` matters only for a position that is not waiting.

FLAT, FLAT_WAITING, LONG_WAITING = (0, 0, None), (0, 1, None), (1, 1, None)
FREE_STATES = (FLAT, FLAT_WAITING, LONG_WAITING)


def is_cut(price: float, paid: float, percent: float) -> bool:
    return price - paid <= -((percent * paid) / 100)


def _trend(price, rsi, ratio, r: Rules) -> bool:
    return bool(r.follow_trend and rsi is not None and rsi > r.high and ratio is not None and ratio > r.rise)


def step(state, price: float, rsi, ratio, sig, r: Rules):
    """Advance one bar: the new state and the event shown on that bar."""
    position, waiting, paid = state
    if waiting:
        return ((1, 0, price), "BUY") if rsi is not None and rsi > RE_ENTRY_RSI else (state, None)
    event = None
    if sig == "BUY" and position == 0:
        position, paid, event = 1, price, "BUY"
    elif sig == "SELL" and position == 1:
        position, paid, event = 0, None, "SELL"
    if r.cut_loss is not None and position == 1 and is_cut(price, paid, r.cut_loss):
        position, waiting, paid, event = 0, 1, None, "SELL"
    if position == 0 and _trend(price, rsi, ratio, r):
        position, paid, event = 1, None if waiting else price, "BUY"
    return (position, waiting, paid), event


def _bars(pdf: pd.DataFrame):
    plain = lambda s: s.astype(object).where(s.notna(), None).tolist()
    return zip(pdf["price"].tolist(), plain(pdf["rsi"]), plain(pdf["rsi_ratio"]), plain(pdf["signal"]))


def summarise_block(pdf: pd.DataFrame, r: Rules) -> list[tuple]:
    """What a block does to every possible start state: rows (kind, rank, cut_at, position, waiting, paid).

    Kind 0-2 are the states without a price.  For a long position of unknown price (kind 3) the
    only thing that depends on the price is when the loss limit is met, and that happens at a new
    low; starts that leave at the same low share their future.  Row ``cut_at = null`` is for
    starts that no low closes; position -1 means they are still held.
    """
    free = {i: s for i, s in enumerate(FREE_STATES)}
    cohorts: list[list] = []      # [low that closes the position, state since then]
    held, rest, low = True, None, float("inf")
    for price, rsi, ratio, sig in _bars(pdf):
        moved = {}
        ahead = lambda s: moved.setdefault(s, step(s, price, rsi, ratio, sig, r)[0])
        free = {i: ahead(s) for i, s in free.items()}
        for c in cohorts:
            c[1] = ahead(c[1])
        if not held:
            rest = ahead(rest)
        elif sig == "SELL":
            held, rest = False, ((1, 0, price) if _trend(price, rsi, ratio, r) else FLAT)
        elif r.cut_loss is not None and price < low:
            low = price
            cohorts.append([price, LONG_WAITING if _trend(price, rsi, ratio, r) else FLAT_WAITING])
        merged = []
        for c in cohorts:
            if merged and merged[-1][1] == c[1]:
                merged[-1] = c
            else:
                merged.append(c)
        cohorts = merged
    out = [(i, 0, None, *s) for i, s in free.items()]
    out += [(3, k, cut, *s) for k, (cut, s) in enumerate(cohorts)]
    out.append((3, len(cohorts), None, *((-1, 0, None) if held else rest)))
    return out


def pass_block(state, rows: list[tuple], r: Rules):
    """The state after a block, from its summary."""
    if state in FREE_STATES:
        kind = FREE_STATES.index(state)
        return next((p, w, paid) for k, _, _, p, w, paid in rows if k == kind)
    for kind, _, cut_at, position, waiting, paid in sorted((x for x in rows if x[0] == 3), key=lambda x: x[1]):
        if cut_at is None or is_cut(cut_at, state[2], r.cut_loss):
            return state if position == -1 else (position, waiting, paid)
    raise AssertionError("the last summary row takes every start")


def folded_position(df: DataFrame, b: Blocks, r: Rules) -> DataFrame:
    """Position and event per bar for the loss-cutting strategies.

    Three steps: every block that has a successor is summed up on its own, the (few) summaries of
    a series are walked in order to find the state after each, and every block is then replayed
    from the state after the block before it.
    """
    keys = list(b.keys)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    key_schema = ", ".join(f"`{k}` {types[k]}" for k in keys)

    def heads(key, rows, names):
        out = pd.DataFrame(rows, columns=names)
        for name, value in zip([*keys, "blk"], key):
            out[name] = value
        return out

    def summarise(key, pdf):
        return heads(key, summarise_block(pdf.sort_values("pos"), r), ["kind", "rank", "cut_at", "position", "waiting", "paid"])

    last = df.groupBy(*keys).agg(F.max("blk").alias("_last"))
    narrow = (df.select(*b.by, "pos", "price", "rsi", "rsi_ratio", "signal").join(last, keys)
              .filter(F.col("blk") < F.col("_last")).drop("_last"))
    summaries = narrow.groupBy(*b.by).applyInPandas(
        summarise, f"{key_schema}, blk bigint, kind int, rank int, cut_at double, position int, waiting int, paid double")

    begin = (r.start, 0, r.start_price if r.start else None)

    def walk(key, pdf):
        state, out = begin, []
        none = lambda v: None if pd.isna(v) else float(v)
        for blk, part in pdf.groupby("blk", sort=True):
            rows = [(int(x.kind), int(x.rank), none(x.cut_at), int(x.position), int(x.waiting), none(x.paid))
                    for x in part.itertuples()]
            state = pass_block(state, rows, r)
            out.append((int(blk) + 1, *state))
        frame = pd.DataFrame(out, columns=["blk", "in_position", "in_waiting", "in_paid"])
        for name, value in zip(keys, key):
            frame[name] = value
        return frame

    starts = summaries.groupBy(*keys).applyInPandas(
        walk, f"{key_schema}, blk bigint, in_position int, in_waiting int, in_paid double")

    def replay(pdf):
        pdf = pdf.sort_values("pos", ignore_index=True)
        first = pdf.iloc[0]
        state, positions, events = begin, [], []
        if not pd.isna(first["in_position"]):
            paid = first["in_paid"]
            state = (int(first["in_position"]), int(first["in_waiting"]), None if pd.isna(paid) else float(paid))
        for bar in _bars(pdf):
            state, event = step(state, *bar, r)
            positions.append(state[0])
            events.append(event)
        return pdf.drop(columns=["in_position", "in_waiting", "in_paid"]).assign(position=positions, strategy=events)

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.join(starts, b.by, "left").groupBy(*b.by).applyInPandas(replay, f"{columns}, position int, strategy string")


def with_position(df: DataFrame, b: Blocks, r: Rules) -> DataFrame:
    return simple_position(df, b, r.start) if r.cut_loss is None else folded_position(df, b, r)


def strategy_return(ret: Column, position: Column, event: Column) -> Column:
    """The bar's return while holding; 0 when flat without an event and on the row that buys."""
    return (F.when((position == 0) & event.isNull(), 0.0)
            .when((position == 1) & (event == "BUY"), 0.0).otherwise(ret))


def back_test(bars: DataFrame, r: Rules, b: Blocks = Blocks()) -> DataFrame:
    """Indicators, signals, positions and both cumulative returns of one rule set on every series."""
    signals = settle(with_signals(S.smoothed_rsi(bars, b, r.sma_n, r.rsi_n), r))
    held = settle(with_position(signals, b, r).withColumn(
        "strategy_ret", strategy_return(F.col("ret"), F.col("position"), F.col("strategy"))))
    summed = S.cumulative(held, b, {"_r": F.col("ret"), "_s": F.col("strategy_ret")})
    return summed.withColumns({"creturns": F.exp("_r"), "strategy_creturns": F.exp("_s")}).drop("_r", "_s")


def grid_frame(bars: DataFrame, periods: list[int], b: Blocks) -> DataFrame:
    """One series per (key, n) with the mean of the last n prices, from one pass over the bars.

    Means come from differences of a running sum inside the block (with the rows it borrows), so
    the cost per bar and period does not grow with the period.
    """
    placed = S.positioned(bars.filter(F.col("price").isNotNull()), b)
    p, top = F.col("price"), max(periods) + 1
    back = lambda k: F.coalesce(F.try_element_at("_held", -(k + 1)), F.lit(0.0))
    mean = lambda n, shift: F.when(F.col("pos") >= n + shift, (back(F.lit(shift)) - back(n + shift)) / n)
    rolled = S.rolling(placed, b, top + 1,
                       lambda w: {"_sum": F.sum(p).over(w), "ret": S.log_return(p, w)},
                       lambda w: {"_held": F.collect_list("_sum").over(w.rowsBetween(-top, 0))})
    rolled = rolled.withColumn("_grid", F.transform(F.lit(periods), lambda n: F.struct(
        n.alias("n"), mean(n, 0).alias("sma"), mean(n, 1).alias("sma_prev"))))
    return (rolled.select(*b.keys, b.time, "pos", "blk", "price", "ret", F.inline("_grid"))
            .withColumn("_change", F.col("sma") - F.col("sma_prev")).drop("sma_prev"))


def rsi_grid(bars: DataFrame, periods: list[int], r: Rules, b: Blocks = Blocks()) -> DataFrame:
    """Final strategy return for each period, used for both the mean and the strength."""
    keyed = b.with_keys("n")
    strong = S.relative_strength(settle(grid_frame(bars, periods, b)), keyed, F.col("_change"), F.col("n"), F.col("n") + 1)
    ready = strong.drop("_change").withColumn("rsi_ratio", F.try_divide(F.col("rsi"), F.nullif(F.col("rsi_prev"), F.lit(0.0))))
    held = with_position(settle(with_signals(ready, r)), keyed, r)
    gained = held.select(*keyed.keys, strategy_return(F.col("ret"), F.col("position"), F.col("strategy")).alias("s"))
    return gained.groupBy(*keyed.keys).agg(F.exp(F.sum("s")).alias("final_return"))


def best_period(grid: DataFrame, keys: list[str]) -> DataFrame:
    """Best final return of each series and the shortest period that reaches it."""
    return grid.groupBy(*keys).agg(F.max("final_return").alias("best_return"),
                                   F.max_by("n", F.struct("final_return", -F.col("n"))).alias("best_n"))


def sma_grid(bars: DataFrame, short: list[int], long: list[int], b: Blocks = Blocks()) -> DataFrame:
    """Minus the final return of holding while the short mean was above the long one, per pair of lengths.

    Every mean is computed once; the pairs are formed inside the row, so no frame is multiplied
    before the final sum.
    """
    placed = S.positioned(bars, b)
    p, lengths = F.col("price"), sorted({*short, *long})
    rolled = S.rolling(placed, b, max(lengths) + 1,
                       lambda w: {"ret": S.log_return(p, w), **{f"m{n}": S.sma(p, n, w) for n in lengths}},
                       lambda w: {f"d{s}_{l}": F.lag(S.cross_direction(F.col(f"m{s}"), F.col(f"m{l}"))).over(w)
                                  for s in short for l in long})
    pairs = F.array(*[F.struct(F.lit(s).alias("short"), F.lit(l).alias("long"),
                               F.when(F.col(f"m{s}").isNotNull() & F.col(f"m{l}").isNotNull()
                                      & F.col(f"d{s}_{l}").isNotNull() & F.col("ret").isNotNull(),
                                      F.when(F.col(f"d{s}_{l}") == 1, F.col("ret")).otherwise(0.0)).alias("s"))
                      for s in short for l in long])
    return (rolled.select(*b.keys, F.inline(pairs)).groupBy(*b.keys, "short", "long")
            .agg((-F.round(F.exp(F.sum("s")), 6)).alias("objective")))


def trade_report(trades: DataFrame, units: float, b: Blocks = Blocks()) -> DataFrame:
    """Value, realised profit and cumulative profit per trade (``strategy`` BUY or SELL at ``price``).

    Every second trade realises the sum of itself and the one before; an open trade is left out
    of the cumulative profit.
    """
    value = F.when(F.col("strategy") == "BUY", -units * F.col("price")).otherwise(units * F.col("price"))
    t = running_sums(trades.withColumn("value", value), [b.time], {"trade": F.lit(1), "_total": F.col("value")}, list(b.keys))
    closes = F.col("trade") % 2 == 0
    pair = Window.partitionBy(*b.keys, F.floor((F.col("trade") - 1) / 2))
    return t.withColumns({
        "profit": F.when(closes, F.round(F.sum("value").over(pair), 3)).otherwise(0.0),
        "cum_profit": F.round(F.when(closes, F.col("_total")).otherwise(F.col("_total") - F.col("value")), 3)}).drop("_total")
