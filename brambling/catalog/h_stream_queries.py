"""Streams over the bar messages, run on what is there and compared with the batch result."""

from pyspark.sql import functions as F

from brambling.catalog.c_series_queries import LIMITED, SIMPLE, TREND, fold_sql
from brambling.catalog.inputs import BARS, bars
from brambling.catalog.registry import query
from brambling.session import new_path, settings, settle
from brambling.streaming import bars as SB, calendar, replace, trading


def messages(t):
    """Each bar as three messages: an early one, the complete one, and the complete one again."""
    ms = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    text = lambda c: F.col(c).cast("string")
    m = bars(t).withColumn("n", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    k = F.struct(ms("open_time").alias("t"), text("open").alias("o"), text("high").alias("h"), text("low").alias("l"),
                 text("price").alias("c"), text("volume").alias("v"), (F.col("n") > 0).alias("x"))
    return m.select(F.to_json(F.struct(F.col("symbol").alias("s"), (ms("open_time") + 3_600_000 + F.col("n")).alias("E"), k.alias("k"))).alias("value"))


def in_time_order(t):
    """Message files in time order, as a live feed would leave them."""
    return messages(t).orderBy(F.get_json_object("value", "$.E").cast("bigint"), "value")


def stream(t):
    path = new_path(t.spark, "messages")
    in_time_order(t).write.text(path)
    return SB.parse_messages(SB.read_messages(t.spark, path))


def plain_time(df):
    return df.withColumn("open_time", F.col("open_time").cast("timestamp_ntz"))


@query("ss1_bar_stream", f"""with {BARS} select symbol, open_time, open, high, low, price, volume, n > 0 as complete from bars, range(3) r(n)""")
def _(t):
    return plain_time(SB.run_available(stream(t), "parsed")).drop("event_time")


@query("ss2_complete_bars", f"with {BARS} select symbol, open_time, open, high, low, price, volume from bars, range(2) r(n)")
def _(t):
    return plain_time(SB.run_available(SB.complete_bars(stream(t)), "complete")).drop("event_time", "complete")


@query("ss3_one_per_bar", f"with {BARS} select * from bars")
def _(t):
    kept = SB.one_per_bar(SB.complete_bars(stream(t)), "1 hour")
    return plain_time(SB.run_available(kept, "deduped")).drop("event_time", "complete")


REPLACED = f"""with {BARS} select symbol, open_time, arg_max(price + (n * 7) % 5, n) as price, open_time::date as day from bars, range(4) r(n) group by 1, 2"""


@query("ss3_replaced_bars", REPLACED)
def _(t):
    """Four messages a bar, each with another price, in files out of order: the latest takes the place of the others."""
    n = F.explode(F.array(*[F.lit(i) for i in range(4)]))
    told = bars(t).withColumn("n", n).select(
        "symbol", F.col("open_time").cast("timestamp").alias("open_time"), (F.col("price") + (F.col("n") * 7) % 5).alias("price"),
        F.to_date("open_time").alias("day"), F.col("n").cast("long").alias("seen"))
    path = new_path(t.spark, "told")
    told.repartition(12, F.xxhash64("symbol", "open_time", "seen")).write.parquet(path)
    source = t.spark.readStream.schema(told.schema).option("maxFilesPerTrigger", 4).parquet(path)
    table = replace.ReplacingTable.new(t.spark, ["symbol", "open_time"], "seen", "day")
    replace.store_replacing(source, table, new_path(t.spark, "told-state")).awaitTermination()
    return plain_time(table.read(t.spark)).select("symbol", "open_time", "price", "day")


@query("io12_replace_results", f"""with {BARS}, told as (select symbol, open_time::date as day, open_time, price, dayofmonth(open_time) % 3 as k from bars)
  select symbol, day, arg_max(price, open_time) as price, count(*) as bars from told where k <> 1 group by 1, 2
  union all select symbol, day, 0.5::double + arg_max(price, open_time), count(*) from told where k = 1 group by 1, 2""")
def _(t):
    """A result log rewritten by key: first results, corrected ones for some days, and the correction once more."""
    told = settle(bars(t).groupBy("symbol", F.to_date("open_time").alias("day")).agg(F.max_by("price", "open_time").alias("price"), F.count(F.lit(1)).alias("bars")))
    table = replace.ReplacingTable.new(t.spark, ["symbol", "day"], "tick", "day")
    table.merge(told.withColumn("tick", F.lit(1)), 0)
    corrected = told.filter(F.dayofmonth("day") % 3 == 1).withColumns({"price": F.col("price") + 0.5, "tick": F.lit(2)})
    table.merge(corrected, 1)
    table.merge(corrected, 1)
    table.merge(told.withColumn("tick", F.lit(1)), 2)       # older results change nothing
    return table.read(t.spark).select("symbol", "day", "price", "bars")


@query("ss4_tick_bars", """select event_type as symbol, time_bucket(interval 15 minute, ts) as open_time, arg_min(value, ts) as open, max(value) as high, min(value) as low, arg_max(value, ts) as price, count(*)::double as volume
  from events group by 1, 2 having time_bucket(interval 15 minute, ts) + interval 15 minute <= (select max(ts) from events) - interval 30 minute""")
def _(t):
    path = new_path(t.spark, "ticks")
    t.events.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), "value").write.parquet(path)
    ticks = t.spark.readStream.schema("symbol string, ts timestamp, value double").parquet(path)
    return plain_time(SB.run_available(SB.tick_bars(ticks, "15m"), "bars"))


@query("ss4_month_bars", """with t as (select event_type as symbol, timestamp '2024-01-01' + (ts - timestamp '2024-01-01') * 9 as ts, value from events)
  select * from (select symbol, date_trunc('month', ts)::timestamp as open_time, arg_min(value, ts) as open, max(value) as high, min(value) as low, arg_max(value, ts) as price, count(*)::double as volume
  from t group by 1, 2) where open_time + interval 1 month <= (select max(ts) from t) - interval 1 day""")
def _(t):
    """Month bars; the events' month is stretched over nine."""
    begin = F.lit("2024-01-01 00:00:00").cast("timestamp")
    at = F.timestamp_micros(F.unix_micros(begin) + 9 * (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(begin)))
    path = new_path(t.spark, "ticks")
    t.events.select(F.col("event_type").alias("symbol"), at.alias("ts"), "value").write.parquet(path)
    ticks = t.spark.readStream.schema("symbol string, ts timestamp, value double").parquet(path)
    with settings(t.spark, trading.ROCKSDB):
        run = SB.run_available(calendar.calendar_bars(ticks, "1M", "1 day"), "months")
    return plain_time(run.filter("late = 0")).drop("late")


DELAY = 12    # days: more than a third of the messages' span, whose files come in any order


def live(t, rules):
    """All bars.  The messages come in three parts of 30 files, shuffled inside each part, with the first hours once
    more in a late file whose older message must not count; an end message gives out what the watermark still holds."""
    path = new_path(t.spark, "messages")
    sent = F.get_json_object("value", "$.E").cast("bigint")
    all_ = settle(messages(t))
    first, last = all_.agg(F.min(sent), F.max(sent)).first()
    for k in range(3):
        all_.filter(F.floor((sent - first) * 3 / (last - first + 1)) == k).select("value").repartition(30, F.xxhash64("value")).write.mode("append").text(path)
    late = all_.filter(sent < first + 10 * 3_600_000).select(
        F.regexp_replace(F.regexp_replace("value", r'"E":\d', '"E":0'), r'"c":"', '"c":"9').alias("value"))
    late.repartition(2).write.mode("append").text(path)
    t.spark.createDataFrame([(trading.end_message(),)], "value string").coalesce(1).write.mode("append").text(path)
    parsed = SB.complete_bars(SB.parse_messages(SB.read_messages(t.spark, path)))
    with settings(t.spark, trading.ROCKSDB):
        run = SB.run_available(trading.live_positions(parsed, rules, f"{DELAY} days"), "positions")
    return plain_time(run.filter(~F.col("late")))


@query("ss5_rolling_state", f"with recursive {SIMPLE} select symbol, open_time, round(sma, 6) as sma, round(rsi, 6) + 0.0::double as rsi from perf")
def _(t):
    return live(t, LIMITED).select("symbol", "open_time", F.round("sma", 6).alias("sma"), (F.round("rsi", 6) + 0.0).alias("rsi"))


@query("ss6_position_state", f"with recursive {fold_sql(TREND)} select sig.symbol, sig.open_time, walk.position, walk.strategy from sig join walk using (symbol, pos)")
def _(t):
    return live(t, TREND).select("symbol", "open_time", "position", "strategy")


@query("ss7_trigger_log", f"with {BARS} select symbol, open_time, price from bars, range(2) r(n)")
def _(t):
    """Polls every second until everything that is there is stored."""
    log = SB.complete_bars(stream(t)).select("symbol", "open_time", "price")
    path = new_path(t.spark, "polled")
    polled = SB.store_available(log, path, new_path(t.spark, "polled-state"), {"processingTime": "1 second"})
    try:
        polled.processAllAvailable()
    finally:
        polled.stop()
    return plain_time(t.spark.read.schema(log.schema).parquet(path))


@query("ss8_result_log", f"with recursive {SIMPLE} select symbol, open_time, price, position, strategy from perf where strategy is not null")
def _(t):
    return live(t, LIMITED).filter("strategy is not null").select("symbol", "open_time", "price", "position", "strategy")


@query("ss9_monitoring_view", f"with recursive {SIMPLE} select symbol, open_time::date as day, count(*) as bars, count(strategy) as events, arg_max(position, pos) as position from perf group by 1, 2")
def _(t):
    log = live(t, LIMITED)
    return log.groupBy("symbol", F.to_date("open_time").alias("day")).agg(
        F.count(F.lit(1)).alias("bars"), F.count("strategy").alias("events"), F.max_by("position", "open_time").alias("position"))
