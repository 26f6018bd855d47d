import numpy as np
import pytest
from pyspark.sql import functions as F

from brambling.operators import vector_index as V


def frame(spark, x, more=()):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + list(more), "id long, v array<double>")


def full_scan(x, queries, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        s = np.round(u @ u[q], 9)
        out[q] = [i for i in np.lexsort((np.arange(len(u)), -s)) if i != q][:k]
    return out


def found(index, queries, **options):
    out = {}
    for r in V.search(index, queries, "id", "v", **options).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


@pytest.mark.parametrize("spread", [0.3, None])
def test_recall_of_every_twentieth_row(spark, spread):
    """Clustered vectors and such without any clusters."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 24)) if spread is None else rng.normal(size=(30, 24))[rng.integers(0, 30, 1500)] + spread * rng.normal(size=(1500, 24))
    df = frame(spark, x)
    index = V.build(df, "id", "v")
    queries = list(range(0, 1500, 20))
    got, want = found(index, df.filter(F.col("id") % 20 == 0)), full_scan(x, queries, 10)
    recall = np.mean([len(set(got[q]) & set(want[q])) / 10 for q in queries])
    assert recall >= 0.9 and set(got) == set(queries)
    if spread:
        assert index.probes <= len(index.centres) / 3


def test_all_probes_give_the_full_scan(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8))
    x[250:] = x[:50]                                                # ties
    df = frame(spark, x)
    index = V.build(df, "id", "v", lists=7, block=16)
    assert found(index, df.filter("id < 40"), probes=7, k=5, group=4) == full_scan(x, range(40), 5)


def test_every_usable_row_is_filed_once(spark):
    x = np.random.default_rng(3).normal(size=(100, 5))
    odd = [(500, None), (501, []), (502, [0.0] * 5), (503, [1.0, None, 1.0, 1.0, 1.0]), (504, [float("nan")] * 5), (505, [1.0, 2.0]), (None, [1.0] * 5)]
    df = frame(spark, x, odd)
    index = V.build(df, "id", "v", block=3)
    ids = np.concatenate([np.frombuffer(r["ids"], np.int64) for r in index.blocks.collect()])
    assert sorted(ids.tolist()) == list(range(100))
    assert max(len(np.frombuffer(r["ids"], np.int64)) for r in index.blocks.collect()) <= 3
    assert found(index, df.filter("id >= 500 or id is null")) == {}
    assert V.build(df.filter("id >= 500 and id < 505"), "id", "v") is None


def test_slices_keep_every_row_and_the_bound(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(V, "HELD", 1_000)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n))], names=["id"]) for n in (0, 1, 250)]
    parts = list(V._slices(batches, 30))
    assert [i for p in parts for i in p.column(0).to_pylist()] == [0, *range(250)] and max(p.num_rows for p in parts) == 33
    assert max(p.num_rows for p in V._slices(batches, 5_000)) == 1


def test_search_in_slices_is_the_same(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(400)], "id long, v array<double>")
    found = []
    for held in (2_000_000, 300):
        monkeypatch.setattr(V, "HELD", held)
        found.append(sorted(map(tuple, V.search(V.build(rows, "id", "v"), rows, "id", "v", 3).collect())))
    assert found[0] == found[1]
