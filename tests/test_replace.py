import pytest
from pyspark.sql import functions as F

from brambling.session import exists
from brambling.streaming import replace as R

SCHEMA = "k string, day string, v double, seen long"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def state(table, spark):
    return sorted(((r["k"], r["day"], r["v"], r["seen"], r["batch"]) for r in table.read(spark).collect()), key=str)


@pytest.fixture()
def table(spark):
    return R.ReplacingTable.new(spark, ["k", "day"], "seen", "day")


def test_later_rows_take_the_place_of_earlier_ones(spark, table):
    table.merge(frame(spark, ("a", "d1", 1.0, 1), ("a", "d1", 2.0, 3), ("b", "d2", 5.0, 1), (None, None, 7.0, 1)), 0)
    assert state(table, spark) == [("a", "d1", 2.0, 3, 0), ("b", "d2", 5.0, 1, 0), (None, None, 7.0, 1, 0)]
    table.merge(frame(spark, ("a", "d1", 9.0, 2), ("b", "d2", 6.0, 2), ("c", "d1", 3.0, 1), (None, None, 8.0, 2)), 1)
    want = [("a", "d1", 2.0, 3, 0), ("b", "d2", 6.0, 2, 1), ("c", "d1", 3.0, 1, 1), (None, None, 8.0, 2, 1)]
    assert state(table, spark) == want
    table.merge(frame(spark, ("b", "d2", 6.0, 2)), 2)           # the same row again
    table.merge(frame(spark), 3)
    assert state(table, spark) == want


def test_only_touched_partitions_are_written(spark, table):
    table.merge(frame(spark, ("a", "d1", 1.0, 1), ("b", "d2", 5.0, 1)), 0)
    files = lambda day: set(table.read(spark).filter(F.col("day") == day).inputFiles())
    before = {f for f in table.read(spark).inputFiles() if "day=d2" in f}
    table.merge(frame(spark, ("a", "d1", 2.0, 2)), 1)
    after = table.read(spark).inputFiles()
    assert before == {f for f in after if "day=d2" in f} and files("d1")


def test_a_repeated_batch_changes_nothing(spark, table):
    first, second = frame(spark, ("a", "d1", 1.0, 1)), frame(spark, ("a", "d1", 2.0, 2), ("b", "d1", 4.0, 1))
    table.merge(first, 0)
    table.merge(second, 1)
    want = state(table, spark)
    table.merge(second, 1)
    assert state(table, spark) == want and not exists(spark, f"{table.staging}/batch-0")


def test_a_merge_broken_off_while_partitions_were_replaced_is_finished(spark, table):
    """The partition was taken away and not yet put back: the staged merge still holds its rows."""
    table.merge(frame(spark, ("a", "d1", 1.0, 1), ("z", "d9", 1.0, 1)), 0)
    second = frame(spark, ("b", "d1", 4.0, 1))
    table.merge(second, 1)
    want = state(table, spark)
    from brambling.session import remove
    remove(spark, f"{table.path}/day=d1")
    table.merge(second, 1)
    assert state(table, spark) == want


def test_a_restarted_stream_goes_on(spark, table, tmp_path):
    source, check = tmp_path / "in", str(tmp_path / "state")
    put = lambda *rows: frame(spark, *rows).coalesce(1).write.mode("append").parquet(str(source))
    run = lambda: R.store_replacing(spark.readStream.schema(SCHEMA).parquet(str(source)), table, check).awaitTermination()
    put(("a", "d1", 1.0, 1), ("b", "d1", 1.0, 1))
    run()
    put(("a", "d1", 5.0, 2), ("b", "d1", 0.0, 0))
    run()
    assert [r[:4] for r in state(table, spark)] == [("a", "d1", 5.0, 2), ("b", "d1", 1.0, 1)]
