import json
import os
import time

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from brambling.operators import series as S, strategy as ST
from brambling.operators.series import Blocks
from brambling.streaming import bars as SB, trading

ROOT = "/root/testdata/sf0.001"
RULES = ST.Rules(sma_n=4, rsi_n=5, low=45, high=60, rise=1.0, cut_loss=2.0, follow_trend=True)


def message(symbol, at, price, complete=True, late=0):
    ms = int(pd.Timestamp(at).timestamp() * 1000)
    k = {"t": ms, "o": "1", "h": "1", "l": "1", "c": str(price), "v": "n/a", "x": complete}
    return json.dumps({"s": symbol, "E": ms + 3_600_000 + late, "k": k})


def put(folder, name, lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def run(stream, out, state):
    SB.store_available(stream, str(out), str(state)).awaitTermination()


def test_messages_are_parsed(spark, tmp_path):
    put(tmp_path, "a", [message("s", "2024-01-01", 2.5), "not json"])
    rows = SB.parse_messages(spark.read.text(str(tmp_path))).collect()
    good = [r for r in rows if r.symbol]
    assert len(rows) == 2 and good[0].price == 2.5 and good[0].volume is None and good[0].complete


def test_carried_state_over_restarts_equals_the_batch(spark, walk, tmp_path):
    pdf, df = walk
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    source.mkdir()
    times = sorted(pdf.open_time.unique())
    cuts = [times[:40], times[40:41], times[41:200], times[200:]]
    for i, cut in enumerate(cuts):
        part = pdf[pdf.open_time.isin(cut)].sample(frac=1, random_state=i)     # shuffled inside the file
        lines = [message(r.symbol, r.open_time, r.price) for r in part.itertuples()]
        lines += [message(r.symbol, r.open_time, r.price + 1, complete=False) for r in part.head(5).itertuples()]
        put(source, f"{i}", lines)
        bars = SB.complete_bars(SB.parse_messages(SB.read_messages(spark, str(source), 1)))
        run(trading.live_positions(bars, RULES, "0 seconds"), out, state)                  # a new query each time: state is restored
    put(source, "late", [message("hot", times[3], 1.0)])
    run(trading.live_positions(SB.complete_bars(SB.parse_messages(SB.read_messages(spark, str(source), 1))), RULES, "0 seconds"), out, state)
    got = spark.read.parquet(str(out)).toPandas().sort_values(["symbol", "open_time"], ignore_index=True)
    late = got[got.late]
    assert len(late) == 1 and late.price.tolist() == [1.0]      # counted, and without effect
    got = got[~got.late].reset_index(drop=True)
    want = ST.back_test(df, RULES, Blocks(rows=64)).toPandas().sort_values(["symbol", "open_time"], ignore_index=True)
    assert len(got) == len(want) == len(pdf)
    assert got.position.tolist() == want.position.tolist()
    assert got.strategy.fillna("").tolist() == want.strategy.fillna("").tolist()
    for c in ("sma", "rsi", "rsi_ratio"):
        assert got[c].fillna(-1).tolist() == pytest.approx(want[c].fillna(-1).tolist())


def test_files_in_any_order_give_the_batch_result(spark, walk, tmp_path):
    """One file a micro-batch, files far out of order within the delay, and an older message for a bar still held."""
    pdf, df = walk
    source = tmp_path / "in"
    source.mkdir()
    times = sorted(pdf.open_time.unique())
    parts = [times[i:i + 40] for i in range(0, len(times), 40)]
    for i, k in enumerate([2, 0, 1, 5, 3, 4, *range(6, len(parts))]):
        rows = pdf[pdf.open_time.isin(parts[k])].sample(frac=1, random_state=i)
        lines = [message(r.symbol, r.open_time, r.price) for r in rows.itertuples()]
        lines += [message(r.symbol, r.open_time, r.price + 7, late=-5000) for r in rows.head(6).itertuples()]
        put(source, f"{i:02}", lines)
        time.sleep(0.02)
    bars = SB.complete_bars(SB.parse_messages(SB.read_messages(spark, str(source), 1)))
    run(trading.live_positions(bars, RULES, "200 hours"), tmp_path / "out", tmp_path / "state")
    got = spark.read.parquet(str(tmp_path / "out")).toPandas().sort_values(["symbol", "open_time"], ignore_index=True)
    closed = pd.Timestamp(times[-1]) + pd.Timedelta(hours=1) - pd.Timedelta(hours=200)
    want = ST.back_test(df, RULES, Blocks(rows=64)).filter(F.col("open_time") <= F.lit(closed)).toPandas().sort_values(["symbol", "open_time"], ignore_index=True)
    assert not got.late.any() and got.price.tolist() == want.price.tolist() and got.position.tolist() == want.position.tolist()
    assert got.rsi.fillna(-1).tolist() == pytest.approx(want.rsi.fillna(-1).tolist())


def test_repeats_are_dropped_within_the_watermark(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    put(source, "0", [message("s", "2024-01-01 00:00", 1.0), message("s", "2024-01-01 01:00", 2.0)])
    put(source, "1", [message("s", "2024-01-01 01:00", 2.0, late=5), message("s", "2024-01-01 02:00", 3.0)])
    bars = SB.one_per_bar(SB.complete_bars(SB.parse_messages(SB.read_messages(spark, str(source), 1))), "1 hour")
    run(bars, tmp_path / "out", tmp_path / "state")
    assert sorted(r.price for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1.0, 2.0, 3.0]


def test_late_ticks_do_not_change_a_closed_bar(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = "symbol string, ts timestamp, value double"

    def tick(name, *rows):
        spark.createDataFrame(pd.DataFrame([("s", pd.Timestamp(t), v) for t, v in rows], columns=["symbol", "ts", "value"]), schema) \
            .coalesce(1).write.mode("append").parquet(str(source))
    ticks = lambda: SB.tick_bars(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source)), "15m")
    tick("a", ("2024-01-01 00:01", 5.0), ("2024-01-01 00:14", 7.0))
    run(ticks(), tmp_path / "out", tmp_path / "state")
    tick("b", ("2024-01-01 02:00", 9.0))
    run(ticks(), tmp_path / "out", tmp_path / "state")
    tick("c", ("2024-01-01 00:05", 100.0), ("2024-01-01 03:00", 1.0))
    run(ticks(), tmp_path / "out", tmp_path / "state")
    first = spark.read.parquet(str(tmp_path / "out")).orderBy("open_time").first()
    assert (first.open, first.high, first.low, first.price, first.volume) == (5.0, 7.0, 5.0, 7.0, 2.0)


def test_end_message_gives_out_what_is_held(spark, walk, tmp_path):
    pdf, df = walk
    source = tmp_path / "in"
    source.mkdir()
    put(source, "0", [message(r.symbol, r.open_time, r.price) for r in pdf.sample(frac=1, random_state=3).itertuples()])
    time.sleep(0.02)
    put(source, "1", [trading.end_message()])
    bars = SB.complete_bars(SB.parse_messages(SB.read_messages(spark, str(source), 1)))
    run(trading.live_positions(bars, RULES, "200 hours"), tmp_path / "out", tmp_path / "state")
    got = spark.read.parquet(str(tmp_path / "out")).toPandas().sort_values(["symbol", "open_time"], ignore_index=True)
    want = ST.back_test(df, RULES, Blocks(rows=64)).toPandas().sort_values(["symbol", "open_time"], ignore_index=True)
    assert not got.late.any() and got.symbol.tolist() == want.symbol.tolist() and got.price.tolist() == want.price.tolist()
    assert got.position.tolist() == want.position.tolist() and got.rsi.fillna(-1).tolist() == pytest.approx(want.rsi.fillna(-1).tolist())


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="needs the shared test tables")
@pytest.mark.parametrize("name", ["ss5_rolling_state", "ss6_position_state", "ss8_result_log", "ss9_monitoring_view"])
def test_live_queries_give_every_bar(spark, name):
    con = duckdb.connect()
    for f in os.listdir(ROOT):
        con.execute(f"create view {f.split('.')[0]} as select * from '{ROOT}/{f}'")
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = sorted(map(repr, (tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall())))
    df = entry.queries()[name](spark, ROOT)
    assert sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect()))) == want
