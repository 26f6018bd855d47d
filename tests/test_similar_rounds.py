import numpy as np
import pytest
from pyspark.sql import DataFrameWriter

from brambling.operators import similar as S
from tests.test_similar import brute, shop


@pytest.mark.parametrize("cosine", [True, False])
def test_lists_are_sent_in_rounds(spark, monkeypatch, cosine):
    """Each round sends a share of the items their lists, and together they give every item's best; ids may be small, wide or negative."""
    monkeypatch.setattr(S, "ROUND", 11_000)
    monkeypatch.setattr(S, "KEPT", 1)
    monkeypatch.setattr(S, "SENT", 500)
    written, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **kw: written.append(path) or parquet(self, path, *a, **kw))
    wide = {3: 1 << 50, 4: -5, 7: -(1 << 40)}
    rows = [(u, wide.get(i, i), q) for u, i, q in shop(np.random.default_rng(4), n=500, crowd=.1)]
    df = spark.createDataFrame(rows, "user long, item long, quantity double")
    got = sorted((r["seed"], r["item"], r["rank"], r["users"], round(r["similarity"], 6)) for r in S.similar_items(df, 3, cosine).collect())
    assert got == brute(rows, 3, cosine)
    assert 3 <= sum("similar-" in path for path in written) <= 12
    narrow = df.filter("item between 0 and 1000").selectExpr("user", "cast(item as int) as item", "quantity")
    few = [r for r in rows if 0 <= r[1] <= 1000]
    got = sorted((r["seed"], r["item"], r["rank"], r["users"], round(r["similarity"], 6)) for r in S.similar_items(narrow, 3, cosine).collect())
    assert got == brute(few, 3, cosine)


@pytest.mark.parametrize("items, width", [([5, 9, 65_540], 2), ([0, 65_536], 4), ([1 << 40, (1 << 40) + 1], 2), ([-3, 4], 2), ([7], 2), ([-(1 << 62), 1 << 62], 8)])
def test_lists_take_the_least_width_that_holds_their_steps(items, width):
    values = np.arange(len(items), dtype="<i4")
    blob = S._packed_list(np.array(items), values)
    assert len(blob) == 9 + (width + 4) * len(items)
    got, told = S._unpacked([blob, blob], np.array([len(items)] * 2), "<i4")
    assert got.tolist() == items * 2 and told.tolist() == values.tolist() * 2
