"""Live bars: messages, complete bars, and bars built from ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from brambling.session import new_path

MESSAGE = T.StructType([
    T.StructField("s", T.StringType()), T.StructField("E", T.LongType()),
    T.StructField("k", T.StructType([T.StructField("t", T.LongType()), *[T.StructField(f, T.StringType()) for f in "ohlcv"],
                                     T.StructField("x", T.BooleanType())]))])

# Bar lengths on offer and their event-time window.
INTERVALS = {"1m": "1 minute", "3m": "3 minutes", "5m": "5 minutes", "15m": "15 minutes", "30m": "30 minutes", "1h": "1 hour",
             "2h": "2 hours", "4h": "4 hours", "6h": "6 hours", "8h": "8 hours", "12h": "12 hours", "1d": "1 day", "3d": "3 days",
             "1w": "1 week"}


def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Bar messages to typed columns (any streaming or batch source with a text column)."""
    m = raw.select(F.from_json(F.col(value).cast("string"), MESSAGE).alias("m"))
    number = lambda name: F.col(f"m.k.{name}").try_cast("double")
    return m.select(F.col("m.s").alias("symbol"), F.timestamp_millis("m.E").alias("event_time"),
                    F.timestamp_millis("m.k.t").alias("open_time"), number("o").alias("open"), number("h").alias("high"),
                    number("l").alias("low"), number("c").alias("price"), number("v").alias("volume"), F.col("m.k.x").alias("complete"))


def complete_bars(messages: DataFrame) -> DataFrame:
    return messages.filter("complete")


def one_per_bar(bars: DataFrame, bar: str = "15 minutes") -> DataFrame:
    """One row per symbol and start; repeats within two bar lengths are dropped, state is bounded by the watermark."""
    length, unit = bar.split(" ", 1)
    return bars.withWatermark("event_time", f"{2 * int(length)} {unit}").dropDuplicatesWithinWatermark(["symbol", "open_time"])


def tick_bars(ticks: DataFrame, interval: str = "15m", time: str = "ts", price: str = "value", symbol: str = "symbol") -> DataFrame:
    """Bars of one length from ticks; ticks later than two bar lengths are dropped (and counted by the query's metrics)."""
    span = INTERVALS[interval]
    length, unit = span.split(" ", 1)
    return (ticks.withWatermark(time, f"{2 * int(length)} {unit}").groupBy(symbol, F.window(time, span).alias("w"))
            .agg(F.min_by(price, time).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
                 F.max_by(price, time).alias("price"), F.count(F.lit(1)).cast("double").alias("volume"))
            .select(symbol, F.col("w.start").alias("open_time"), "open", "high", "low", "price", "volume"))


def store_available(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append a stream's results to a Parquet log, taking what is there now (or at the given trigger)."""
    query = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"availableNow": True})).start(path))
    return query


def run_available(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over the data there is and read its log back."""
    spark = stream.sparkSession
    path = new_path(spark, label)
    store_available(stream, path, new_path(spark, f"{label}-state")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def read_messages(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """Message texts from a growing folder (a broker topic with a ``value`` column works the same).

    The limit bounds a micro-batch, also on the first run over a long backlog.
    """
    return spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path)
