import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brambling.operators import series as S, strategy as ST
from brambling.operators.series import Blocks

SMALL = Blocks(rows=37)


def wilder(price, sma_n, n):
    """The recursion in plain steps."""
    sma = pd.Series(price).rolling(sma_n).mean().to_numpy()
    out, gain, loss, seen = np.full(len(price), np.nan), 0.0, 0.0, 0
    for i in range(1, len(price)):
        if np.isnan(sma[i - 1]):
            continue
        change = sma[i] - sma[i - 1]
        up, down = max(change, 0), max(-change, 0)
        seen += 1
        if seen <= n:
            gain, loss = gain + up / n, loss + down / n
        else:
            gain, loss = (gain * (n - 1) + up) / n, (loss * (n - 1) + down) / n
        if seen >= n and gain + loss:
            out[i] = 100 * gain / (gain + loss)
    return out


def by_series(pdf):
    return {k: g.sort_values("open_time") for k, g in pdf.groupby("symbol")}


def test_rolling_and_cumulative_across_blocks(walk):
    pdf, df = walk
    p = F.col("price")
    out = S.rolling(S.positioned(df, SMALL), SMALL, 20, lambda w: {"m": S.sma(p, 12, w), "r": S.log_return(p, w), "l": S.lag_values(p, 5, w)})
    out = S.cumulative(out, SMALL, {"c": F.col("r")}).toPandas()
    assert len(out) == len(pdf)
    for k, g in by_series(out).items():
        want = by_series(pdf)[k].price.reset_index(drop=True)
        assert np.allclose(g.m, want.rolling(12).mean(), equal_nan=True)
        r = np.log(want / want.shift())
        assert np.allclose(g.r.astype(float), r, equal_nan=True) and np.allclose(g.c.astype(float), r.cumsum(), equal_nan=True)
        assert g.pos.tolist() == list(range(1, len(g) + 1))
        for i, held in enumerate(g.l):
            assert (held is None) == (i < 5) and (held is None or list(held) == want[i - 5:i].tolist())


@pytest.mark.parametrize("blocks", [SMALL, Blocks()])
def test_strength_is_the_recursion(walk, blocks):
    pdf, df = walk
    out = S.smoothed_rsi(df, blocks, 5, 6).toPandas()
    for k, g in by_series(out).items():
        want = wilder(by_series(pdf)[k].price.to_numpy(), 5, 6)
        assert np.allclose(g.rsi.astype(float), want, equal_nan=True)
        assert np.allclose(g.rsi_prev.astype(float), np.append(np.nan, want[:-1]), equal_nan=True)


def test_periods_and_lookbacks_longer_than_many_blocks(walk):
    pdf, df = walk
    df, few = df.filter("symbol <> 'c'"), Blocks(rows=7)
    out = S.smoothed_rsi(df, few, 30, 25).toPandas()
    for k, g in by_series(out).items():
        want = wilder(by_series(pdf)[k].price.to_numpy(), 30, 25)
        assert np.allclose(g.rsi.astype(float), want, equal_nan=True) and np.isfinite(want).any()


def test_carried_averages_have_no_reach():
    """Two thousand blocks, a period far above their sum: the plain recursion is the measure."""
    rng = np.random.default_rng(0)
    rows, n, seed, blocks = 4, 5_000, 5, 2_000
    gain, loss = rng.random((2, blocks * rows))
    total, marks = np.zeros(2), []
    for i in range(blocks * rows):
        if i % rows == 0:
            marks.append(tuple(total))
        total = total * ((n - 1) / n if i + 1 > seed else 1.0) + np.array([gain[i], loss[i]]) / n
    power = lambda pos, end: ((n - 1) / n) ** np.maximum(0, end - np.maximum(pos, seed)) / n
    frame = []
    for k in range(blocks):
        pos, end = np.arange(k * rows, (k + 1) * rows) + 1, (k + 1) * rows
        frame.append(("s", k, float(n), seed, end, (gain[pos - 1] * power(pos, end)).sum(), (loss[pos - 1] * power(pos, end)).sum()))
    pdf = pd.DataFrame(frame, columns=["symbol", "blk", "_n", "_seed", "_end", "_g", "_l"]).sample(frac=1, random_state=1)
    got = S._carry_averages(Blocks(rows=rows))(pdf)
    assert np.allclose(got.sort_values("blk")[["_g0", "_l0"]].to_numpy(), np.array(marks))


def loop(g, r):
    """All bars of one series, one after the other."""
    state, rows = (r.start, 0, r.start_price), []
    none = lambda v: None if pd.isna(v) else v
    for bar in g.itertuples():
        state, event = ST.step(state, bar.price, none(bar.rsi), none(bar.rsi_ratio), none(bar.signal), r)
        rows.append((state[0], event))
    return rows


RULES = [ST.Rules(low=45, high=65), ST.Rules(low=45, high=65, cut_loss=2.0), ST.Rules(low=48, high=55, cut_loss=1.0),
         ST.Rules(low=45, high=60, rise=1.0, cut_loss=1.5, follow_trend=True),
         ST.Rules(low=45, high=60, rise=1.0, fall=1.002, cut_loss=3.0, follow_trend=True, start=1, start_price=52.0)]


@pytest.mark.parametrize("r", RULES)
@pytest.mark.parametrize("rows", [21, 65_536])
def test_positions_are_those_of_the_loop(walk, r, rows):
    b = Blocks(rows=rows)
    df = ST.settle(ST.with_signals(S.smoothed_rsi(walk[1], b, r.sma_n, r.rsi_n), r))
    out = ST.with_position(df, b, r).toPandas()
    events = 0
    for k, g in by_series(out).items():
        want = loop(g, r)
        assert g.position.tolist() == [p for p, _ in want]
        assert [e or None for e in g.strategy.where(g.strategy.notna(), None)] == [e for _, e in want]
        events += sum(e is not None for _, e in want)
    assert events > 5


def test_window_form_equals_the_fold(walk):
    r = ST.Rules(low=45, high=65)
    b = Blocks(rows=25)
    df = ST.settle(ST.with_signals(S.smoothed_rsi(walk[1], b, 5, 6), r))
    key = ["symbol", "open_time", "position", "strategy"]
    a, c = ST.simple_position(df, b).select(key), ST.folded_position(df, b, r).select(key)
    assert a.exceptAll(c).isEmpty() and c.exceptAll(a).isEmpty()


def test_block_summary_covers_every_start():
    rng = np.random.default_rng(5)
    r = ST.Rules(low=45, high=60, rise=1.0, cut_loss=1.5, follow_trend=True)
    for _ in range(60):
        n = int(rng.integers(1, 40))
        pdf = pd.DataFrame({"price": np.round(50 + np.cumsum(rng.normal(0, .6, n)), 2), "rsi": rng.uniform(20, 80, n),
                            "rsi_ratio": rng.uniform(.9, 1.1, n), "signal": rng.choice(["BUY", "SELL", None, None, None], n)})
        rows = ST.summarise_block(pdf, r)
        for start in [*ST.FREE_STATES, *[(1, 0, float(p)) for p in rng.uniform(40, 60, 12)]]:
            state = start
            for bar in ST._bars(pdf):
                state, _ = ST.step(state, *bar, r)
            assert ST.pass_block(start, rows, r) == state


def test_same_bar_re_entry_stays_in_waiting_mode():
    r = ST.Rules(low=30, high=70, rise=1.0, cut_loss=1.0, follow_trend=True)
    state, event = ST.step((1, 0, 100.0), 90.0, 80.0, 1.1, None, r)
    assert state == ST.LONG_WAITING and event == "BUY"
    state, event = ST.step(state, 91.0, 50.0, 1.0, None, r)
    assert state == (1, 0, 91.0) and event == "BUY"


def test_undefined_rule_sets_are_refused():
    with pytest.raises(ValueError):
        ST.Rules(follow_trend=True)
    with pytest.raises(ValueError):
        ST.Rules(cut_loss=1.0, start=1)


def test_grid_equals_single_runs(walk):
    r = ST.Rules(low=40, high=60, rise=1.0, cut_loss=2.0, follow_trend=True)
    b = Blocks(rows=48)
    got = {(x.symbol, x.n): x.final_return for x in ST.rsi_grid(walk[1], [6, 9, 14], r, b).collect()}
    for n in (6, 9, 14):
        one = ST.Rules(sma_n=n, rsi_n=n, low=40, high=60, rise=1.0, cut_loss=2.0, follow_trend=True)
        last = ST.back_test(walk[1], one, b).groupBy("symbol").agg(F.max_by("strategy_creturns", "pos").alias("v")).collect()
        for row in last:
            assert got[row.symbol, n] == pytest.approx(row.v)


def test_trade_report(spark):
    rows = [("a", 1, "BUY", 10.0), ("a", 2, "SELL", 12.0), ("a", 3, "BUY", 11.0), ("a", 4, "SELL", 9.0), ("a", 5, "BUY", 8.0)]
    df = spark.createDataFrame(rows, "symbol string, open_time int, strategy string, price double")
    out = [(r.profit, r.cum_profit) for r in ST.trade_report(df, 1.0).orderBy("open_time").collect()]
    assert out == [(0.0, 0.0), (2.0, 2.0), (0.0, 2.0), (-2.0, 0.0), (0.0, 0.0)]
