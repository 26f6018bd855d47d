import numpy as np
import pandas as pd
import pytest

from brambling.streaming import bars as SB, calendar as C

SCHEMA = "symbol string, ts timestamp, value double"


@pytest.mark.parametrize("interval", ["1M", "3M"])
def test_bars_of_calendar_periods(spark, tmp_path, interval):
    """Ticks in any order over several micro-batches give the batch result; a late tick is counted and changes nothing."""
    rng = np.random.default_rng(3)
    at = pd.Timestamp("2023-11-20") + pd.to_timedelta(np.sort(rng.random(300)) * 200, unit="D")
    pdf = pd.DataFrame({"symbol": rng.choice(["a", "b"], 300), "ts": at.floor("us"), "value": np.round(rng.normal(50, 9, 300), 2)})
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def put(part):
        spark.createDataFrame(part.sample(frac=1, random_state=1), SCHEMA).coalesce(1).write.mode("append").parquet(str(source))

    def run():
        ticks = spark.readStream.schema(SCHEMA).parquet(str(source))
        SB.store_available(C.calendar_bars(ticks, interval, "0 seconds"), out, state).awaitTermination()
    for part in np.array_split(np.arange(300), 4):
        put(pdf.iloc[part])
        run()
    late = pd.DataFrame({"symbol": ["a", "a"], "ts": [pd.Timestamp("2023-12-05"), pd.Timestamp("2023-12-06")], "value": [1e6, -1e6]})
    put(late)
    run()
    got = spark.read.parquet(out).toPandas()
    assert got[got.late > 0].late.tolist() == [2]
    got = got[got.late == 0].sort_values(["symbol", "open_time"], ignore_index=True)
    pdf["open_time"] = pdf.ts.dt.to_period("Q" if interval == "3M" else "M").dt.start_time
    end = pdf.ts.dt.to_period("Q" if interval == "3M" else "M").dt.end_time
    closed = pdf[end < pdf.ts.max()].sort_values("ts")
    want = closed.groupby(["symbol", "open_time"]).value.agg(open="first", high="max", low="min", price="last", volume="size").reset_index()
    assert got.open_time.tolist() == want.open_time.tolist() and len(want) >= 2
    for c in ("open", "high", "low", "price", "volume"):
        assert got[c].tolist() == pytest.approx(want[c].tolist())
