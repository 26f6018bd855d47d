"""Indicators, strategies and reports over price bars."""

from pyspark.sql import functions as F

from brambling.catalog.inputs import BARS, DAILY, bars, daily
from brambling.catalog.registry import query
from brambling.operators import aggregate as A, ordering, series as S, strategy as ST
from brambling.operators.series import Blocks
from brambling.sources import bars as B

BY = Blocks()
RULES = ST.Rules(sma_n=5, rsi_n=6, low=35.0, high=65.0)
LIMITED = ST.Rules(sma_n=5, rsi_n=6, low=35.0, high=65.0, rise=1.0, fall=1.002)
CUT = ST.Rules(sma_n=5, rsi_n=6, low=45.0, high=65.0, cut_loss=30.0)
TREND = ST.Rules(sma_n=5, rsi_n=6, low=45.0, high=60.0, rise=1.0, cut_loss=30.0, follow_trend=True)

POS = f"""{BARS}, b as (select *, row_number() over (partition by symbol order by open_time) as pos from bars)"""
SMA = lambda n: (f"case when count(price) over (partition by symbol order by pos rows {n - 1} preceding) = {n} "
                 f"then avg(price) over (partition by symbol order by pos rows {n - 1} preceding) end")
W = "over (partition by symbol order by pos)"
# relative strength of the 5-bar mean over 6 changes, as the textbook recursion
RSI = f"""{POS}, s as (select *, ln(price / lag(price) {W}) as ret, {SMA(5)} as sma from b),
  x as (select *, sma - lag(sma) {W} as ch from s),
  seed as (select symbol, 11::bigint as pos, avg(greatest(ch, 0)) as g, avg(greatest(-ch, 0)) as l from x where pos between 6 and 11 group by symbol),
  rec as (select * from seed union all select rec.symbol, x.pos, (rec.g * 5 + greatest(x.ch, 0)) / 6, (rec.l * 5 + greatest(-x.ch, 0)) / 6
    from rec join x on x.symbol = rec.symbol and x.pos = rec.pos + 1),
  q as (select x.symbol, x.open_time, x.pos, x.price, x.ret, x.sma, 100 * g / nullif(g + l, 0) as rsi
    from x left join rec on rec.symbol = x.symbol and rec.pos = x.pos),
  rsi as (select *, rsi / nullif(lag(rsi) {W}, 0) as rsi_ratio from q)"""


def signal_sql(r):
    sell = f"rsi > {r.high}" + (f" and rsi_ratio < {r.fall}" if r.fall is not None else "")
    buy = f"rsi < {r.low}" + (f" and rsi_ratio > {r.rise}" if r.rise is not None else "")
    return f"sig as (select *, case when {buy} then 'BUY' when {sell} then 'SELL' end as signal from rsi)"


SIMPLE = f"""{RSI}, {signal_sql(LIMITED)}, st as (select *, coalesce(last_value(case signal when 'BUY' then 1 when 'SELL' then 0 end ignore nulls)
    over (partition by symbol order by pos rows unbounded preceding), 0) as position from sig),
  ev as (select *, case position - coalesce(lag(position) {W}, 0) when 1 then 'BUY' when -1 then 'SELL' end as strategy from st),
  perf as (select *, case when position = 0 and strategy is null then 0.0::double when position = 1 and strategy = 'BUY' then 0.0::double else ret end as strategy_ret from ev)"""


def fold_sql(r):
    """One recursive step per bar: after the signal, after the loss limit, after the trend rule."""
    trend = f"s.rsi > {r.high} and s.rsi_ratio > {r.rise}" if r.follow_trend else "false"
    return f"""{RSI}, {signal_sql(r)}, walk as (
      select symbol, 0::bigint as pos, 0 as position, 0 as waiting, 0.0::double as paid, null::varchar as strategy from sig group by symbol
      union all
      select symbol, pos, case when w0 = 1 then case when rsi > 40 then 1 else p0 end when p2 = 0 and trend then 1 else p2 end,
        case when w0 = 1 then case when rsi > 40 then 0 else 1 end else w2 end,
        case when w0 = 1 then case when rsi > 40 then price else paid0 end when p2 = 0 and trend then price else paid1 end,
        case when w0 = 1 then case when rsi > 40 then 'BUY' end when p2 = 0 and trend then 'BUY' when p1 = 1 and p2 = 0 then 'SELL' else e1 end
      from (select *, case when p1 = 1 and price - paid1 <= -(({r.cut_loss} * paid1) / 100) then 0 else p1 end as p2,
              case when p1 = 1 and price - paid1 <= -(({r.cut_loss} * paid1) / 100) then 1 else 0 end as w2
        from (select s.symbol, s.pos, s.price, s.rsi, walk.position as p0, walk.waiting as w0, walk.paid as paid0, coalesce({trend}, false) as trend,
            case when s.signal = 'BUY' then 1 when s.signal = 'SELL' then 0 else walk.position end as p1,
            case when s.signal = 'BUY' and walk.position = 0 then s.price else walk.paid end as paid1,
            case when s.signal = 'BUY' and walk.position = 0 then 'BUY' when s.signal = 'SELL' and walk.position = 1 then 'SELL' end as e1
          from walk join sig s on s.symbol = walk.symbol and s.pos = walk.pos + 1)))"""


def r(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) + 0.0 for n in names})


def strong(t, rules=RULES):
    return ST.with_signals(S.smoothed_rsi(bars(t), BY, rules.sma_n, rules.rsi_n), rules)


def held(t, rules):
    return ST.with_position(ST.settle(strong(t, rules)), BY, rules)


@query("wn1_sma", f"""with {POS} select symbol, open_time, round({SMA(5)}, 9) as sma5, round({SMA(24)}, 9) as sma24, round({SMA(96)}, 9) as sma96 from b""")
def _(t):
    p = F.col("price")
    out = S.rolling(S.positioned(bars(t), BY), BY, 96, lambda w: {f"sma{n}": S.sma(p, n, w) for n in (5, 24, 96)})
    return r(out.select("symbol", "open_time", "sma5", "sma24", "sma96"), "sma5", "sma24", "sma96", digits=9)


@query("wn2_lag", f"with {POS} select symbol, open_time, lag(price, 1) {W} as lag1, lag(price, 2) {W} as lag2 from b")
def _(t):
    out = S.rolling(S.positioned(bars(t), BY), BY, 2, lambda w: {f"lag{k}": F.lag("price", k).over(w) for k in (1, 2)})
    return out.select("symbol", "open_time", "lag1", "lag2")


def returns(t):
    return S.rolling(S.positioned(bars(t), BY), BY, 1, lambda w: {"ret": S.log_return(F.col("price"), w)})


@query("wn3_log_return", f"with {POS} select symbol, open_time, round(ln(price / lag(price) {W}), 6) + 0.0::double as ret from b")
def _(t):
    return r(returns(t).select("symbol", "open_time", "ret"), "ret")


@query("wn4_cum_return", f"""with {POS}, x as (select *, ln(price / lag(price) {W}) as ret from b)
  select symbol, open_time, case when ret is not null then round(exp(sum(ret) {W}), 6) end as creturns from x""")
def _(t):
    out = S.cumulative(returns(t), BY, {"c": F.col("ret")})
    return out.select("symbol", "open_time", F.round(F.exp("c"), 6).alias("creturns"))


@query("wn5_rsi", f"with recursive {RSI} select symbol, open_time, round(rsi, 6) + 0.0::double as rsi from rsi")
def _(t):
    return r(S.smoothed_rsi(bars(t), BY, 5, 6).select("symbol", "open_time", "rsi"), "rsi")


@query("wn6_rsi_ratio", f"with recursive {RSI} select symbol, open_time, round(rsi_ratio, 5) + 0.0::double as rsi_ratio from rsi")
def _(t):
    return r(S.smoothed_rsi(bars(t), BY, 5, 6).select("symbol", "open_time", "rsi_ratio"), "rsi_ratio", digits=5)


@query("wn7_indicator", f"with recursive {RSI} select symbol, open_time, case when rsi < 35 then 1 when rsi > 65 then 0 end as indicator from rsi")
def _(t):
    return strong(t).select("symbol", "open_time", "indicator")


@query("wn8_rsi_signal", f"with recursive {RSI}, {signal_sql(LIMITED)} select symbol, open_time, signal from sig")
def _(t):
    return strong(t, LIMITED).select("symbol", "open_time", "signal")


@query("wn9_position", f"with recursive {SIMPLE} select symbol, open_time, position, strategy from perf")
def _(t):
    return held(t, LIMITED).select("symbol", "open_time", "position", "strategy")


@query("wn10_position_cutloss", f"with recursive {fold_sql(CUT)} select sig.symbol, sig.open_time, walk.position, walk.strategy from sig join walk using (symbol, pos)")
def _(t):
    return held(t, CUT).select("symbol", "open_time", "position", "strategy")


@query("wn11_position_trend", f"with recursive {fold_sql(TREND)} select sig.symbol, sig.open_time, walk.position, walk.strategy from sig join walk using (symbol, pos)")
def _(t):
    return held(t, TREND).select("symbol", "open_time", "position", "strategy")


@query("wn13_strategy_return", f"with recursive {SIMPLE} select symbol, open_time, round(strategy_ret, 6) + 0.0::double as strategy_ret from perf")
def _(t):
    out = held(t, LIMITED).withColumn("strategy_ret", ST.strategy_return(F.col("ret"), F.col("position"), F.col("strategy")))
    return r(out.select("symbol", "open_time", "strategy_ret"), "strategy_ret")


@query("wn14_strategy_cum_return", f"""with recursive {SIMPLE} select symbol, open_time, position, strategy,
  case when ret is not null then round(exp(sum(ret) {W}), 6) end as creturns,
  case when strategy_ret is not null then round(exp(sum(strategy_ret) {W}), 6) end as strategy_creturns from perf""")
def _(t):
    out = ST.back_test(bars(t), LIMITED)
    return r(out.select("symbol", "open_time", "position", "strategy", "creturns", "strategy_creturns"), "creturns", "strategy_creturns")


CROSS = f"""{POS}, m as (select *, {SMA(5)} as s, {SMA(24)} as l from b),
  d as (select *, case when s > l then 1 else -1 end as direction, case when s > l then 1 when s < l then -1 else 0 end as flat_direction,
    ln(price / lag(price) {W}) as ret from m),
  p as (select *, lag(direction) {W} as prev from d)"""


def crossed(t):
    p = F.col("price")
    return S.rolling(S.positioned(bars(t), BY), BY, 26,
                     lambda w: {"s": S.sma(p, 5, w), "l": S.sma(p, 24, w), "ret": S.log_return(p, w)},
                     lambda w: {"direction": S.cross_direction(F.col("s"), F.col("l")),
                                "flat_direction": S.cross_direction(F.col("s"), F.col("l"), ties_flat=True)},
                     lambda w: {"prev": F.lag("direction").over(w), "event": S.crossover_event(F.col("direction"), w)})


@query("wn15_sma_cross_direction", f"with {CROSS} select symbol, open_time, direction, flat_direction from p")
def _(t):
    return crossed(t).select("symbol", "open_time", "direction", "flat_direction")


@query("wn16_crossover_event", f"with {CROSS} select symbol, open_time, case direction - prev when 2 then 1 when -2 then -1 else 0 end as event from p")
def _(t):
    return crossed(t).select("symbol", "open_time", "event")


@query("wn17_crossover_returns", f"""with {CROSS}, k as (select *, case when prev = 1 then ret else 0 end as st from p where s is not null and l is not null and ret is not null and prev is not null)
  select symbol, open_time, round(exp(sum(ret) {W}), 6) as creturns, round(exp(sum(st) {W}), 6) as cstrategy from k""")
def _(t):
    kept = crossed(t).na.drop(subset=["s", "l", "ret", "prev"]).withColumn("st", F.when(F.col("prev") == 1, F.col("ret")).otherwise(0.0))
    out = S.cumulative(kept, BY, {"c": F.col("ret"), "cs": F.col("st")})
    return out.select("symbol", "open_time", F.round(F.exp("c"), 6).alias("creturns"), F.round(F.exp("cs"), 6).alias("cstrategy"))


SHORT, LONG = [3, 5, 8], [12, 24, 48]


@query("wn18_sma_grid", f"""with {POS}, lens as (select unnest([3, 5, 8]) as short), lens2 as (select unnest([12, 24, 48]) as long),
  m as (select symbol, pos, price, ln(price / lag(price) {W}) as ret, {', '.join(f'{SMA(n)} as m{n}' for n in SHORT + LONG)} from b),
  g as (select *, case short when 3 then m3 when 5 then m5 else m8 end as s, case long when 12 then m12 when 24 then m24 else m48 end as l from m, lens, lens2),
  d as (select *, lag(case when s > l then 1 else -1 end) over (partition by symbol, short, long order by pos) as prev from g)
  select symbol, short, long, -round(exp(sum(case when prev = 1 then ret else 0 end)), 6) as objective from d
  where s is not null and l is not null and prev is not null and ret is not null group by all""")
def _(t):
    return ST.sma_grid(bars(t), SHORT, LONG)


@query("wn18_best_pair", f"""with {POS}, lens as (select unnest([3, 5, 8]) as short), lens2 as (select unnest([12, 24, 48]) as long),
  m as (select symbol, pos, price, ln(price / lag(price) {W}) as ret, {', '.join(f'{SMA(n)} as m{n}' for n in SHORT + LONG)} from b),
  g as (select *, case short when 3 then m3 when 5 then m5 else m8 end as s, case long when 12 then m12 when 24 then m24 else m48 end as l from m, lens, lens2),
  d as (select *, lag(case when s > l then 1 else -1 end) over (partition by symbol, short, long order by pos) as prev from g),
  o as (select symbol, short, long, -round(exp(sum(case when prev = 1 then ret else 0 end)), 6) as objective from d
    where s is not null and l is not null and prev is not null and ret is not null group by all)
  select symbol, arg_min(short, (objective, short, long)) as short, arg_min(long, (objective, short, long)) as long, min(objective) as objective from o group by symbol""")
def _(t):
    at = F.struct("objective", "short", "long")
    return ST.sma_grid(bars(t), SHORT, LONG).groupBy("symbol").agg(
        F.min_by("short", at).alias("short"), F.min_by("long", at).alias("long"), F.min("objective").alias("objective"))


@query("wn19_rsi_grid")
def _(t):
    rules = ST.Rules(low=10.0, high=90.0, rise=1.0, fall=1.0, cut_loss=2.0, follow_trend=True)
    return ST.best_period(ST.rsi_grid(bars(t), list(range(6, 100)), rules), ["symbol"])


@query("wn20_day_slices", f"with {POS} select symbol, open_time, floor((pos - 1) / 96)::bigint as slice, price from b where pos <= 96 * 20")
def _(t):
    sliced = S.positioned(bars(t), BY).withColumn("slice", F.floor((F.col("pos") - 1) / 96)).filter(F.col("slice") < 20)
    return sliced.select("symbol", "open_time", "slice", "price")


@query("wn21_price_delta", f"""with {DAILY}, e as (select symbol, arg_min(close, date) as s, arg_max(close, date) as e from daily group by symbol)
  select symbol, round(e, 2) as last, round(e - s, 2) as difference, round(round(e - s, 2) / (s + 1e-6::double) * 100, 2) as change from e""")
def _(t):
    d = daily(t).groupBy("symbol").agg(F.min_by("close", "date").alias("s"), F.max_by("close", "date").alias("e"))
    diff = F.round(F.col("e") - F.col("s"), 2)
    return d.select("symbol", F.round("e", 2).alias("last"), diff.alias("difference"),
                    F.round(diff / (F.col("s") + 1e-6) * 100, 2).alias("change"))


@query("wn22_trade_report", f"""with recursive {SIMPLE}, tr as (select symbol, open_time, strategy, price, case strategy when 'BUY' then -2.0::double * price else 2.0::double * price end as value,
    row_number() over (partition by symbol order by pos) as trade from perf where strategy is not null),
  c as (select *, sum(value) over (partition by symbol order by trade) as total, lag(value) over (partition by symbol order by trade) as before from tr)
  select symbol, open_time, trade, strategy, round(value, 6) as value, case when trade % 2 = 0 then round(value + before, 3) else 0.0::double end as profit,
    round(case when trade % 2 = 0 then total else total - value end, 3) + 0.0::double as cum_profit from c""")
def _(t):
    trades = held(t, LIMITED).filter(F.col("strategy").isNotNull()).select("symbol", "open_time", "strategy", "price")
    out = ST.trade_report(trades, 2.0)
    return r(out.select("symbol", "open_time", F.col("trade").cast("bigint").alias("trade"), "strategy", F.round("value", 6).alias("value"), "profit", "cum_profit"), "cum_profit", digits=3)


@query("wn23_lag_matrix", f"""with {POS}, l as (select symbol, open_time, price as target, array_agg(price) over (partition by symbol order by pos rows between 60 preceding and 1 preceding) as lags from b)
  select symbol, open_time, target, lags[1] as oldest, lags[60] as newest, round(list_sum(lags), 4) as total from l where len(lags) = 60""")
def _(t):
    out = S.rolling(S.positioned(bars(t), BY), BY, 60, lambda w: {"lags": S.lag_values(F.col("price"), 60, w)}).filter("lags is not null")
    return out.select("symbol", "open_time", F.col("price").alias("target"), F.col("lags")[0].alias("oldest"), F.col("lags")[59].alias("newest"),
                      F.round(F.aggregate("lags", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query("wn24_tail_context", f"with {POS} select symbol, open_time, price from b qualify row_number() over (partition by symbol order by pos desc) <= 100 + 60")
def _(t):
    from brambling.operators.split import tail_context
    return tail_context(bars(t), "symbol", "open_time", 100 + 60).select("symbol", "open_time", "price")


@query("wn25_latest_bar", f"with {BARS} select * from bars qualify row_number() over (partition by symbol order by open_time desc) = 1")
def _(t):
    b = bars(t)
    return b.groupBy("symbol").agg(F.max_by(F.struct(*b.columns), "open_time").alias("bar")).select("bar.*")


@query("wn26_monthly_trend", "select month(o_orderdate)::int as month, round(avg(o_totalprice), 4) as mean from orders group by 1")
def _(t):
    m = A.group_mean(t.orders.withColumn("month", F.month("o_orderdate")), ["month"], "o_totalprice")
    return r(m, "mean", digits=4).orderBy("month")


@query("wn27_event_extracts", f"""with recursive {SIMPLE} select symbol, open_time, round(price, 2) as price, round(rsi, 2) as rsi, signal, strategy
  from perf where rsi < 35 or rsi > 65 or signal is not null or strategy is not null""")
def _(t):
    out = held(t, LIMITED).filter("indicator in (0, 1) or signal in ('BUY', 'SELL') or strategy in ('BUY', 'SELL')")
    return out.select("symbol", "open_time", F.round("price", 2).alias("price"), F.round("rsi", 2).alias("rsi"), "signal", "strategy")


# --- bar sources -------------------------------------------------------------------------------


@query("io7_read_bars", f"""with {BARS} select symbol, open_time, case when hour(open_time) = 3 then null else open end as open, price, volume from bars
  where open_time >= timestamp '2024-01-03' and open_time < timestamp '2024-01-25 12:00:00'""")
def _(t):
    text = lambda c: F.col(c).cast("string")
    ms = (F.unix_seconds(F.col("open_time").cast("timestamp")) * 1000).cast("string")
    raw = bars(t).select("symbol", F.array(
        ms, F.when(F.hour("open_time") == 3, "n/a").otherwise(text("open")), text("high"), text("low"), text("price"), text("volume"),
        ms, F.lit("0"), F.lit("0"), F.lit("0"), F.lit("0"), F.lit("0")).alias("kline"))
    return B.read_bars(raw, "2024-01-03", "2024-01-25 12:00:00").select("symbol", "open_time", "open", "price", "volume")


@query("io8_lookback_start", f"""with {BARS} select * exclude (high, low) from bars where open_time >= timestamp '2024-01-20' - 96 * interval 30 minute""")
def _(t):
    start = B.lookback_start(F.lit("2024-01-20").cast("timestamp_ntz"), 96)
    return bars(t).filter(F.col("open_time") >= start).drop("high", "low")


@query("io9_earliest_time", f"with {BARS} select symbol, min(open_time) as earliest from bars group by symbol")
def _(t):
    return B.earliest_time(bars(t))


@query("io10_load_prices", "select event_type as symbol, ts::date as date, value as close from events where ts::date between date '2024-01-05' and date '2024-01-20'")
def _(t):
    e = t.events.select(F.col("event_type").alias("symbol"), "ts", F.col("value").alias("close"))
    return B.load_prices(e, "ts", "2024-01-05", "2024-01-20").select("symbol", "date", "close")
