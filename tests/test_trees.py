import numpy as np
import pytest
from pyspark.sql import functions as F

from brambling.operators import models as M


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 60, 800), np.round(rng.normal(0, 2, 800), 2)
    y = (a // 7) * 2.0 + np.sin(b) + rng.normal(0, .1, 800)
    frame = spark.createDataFrame([(i, float(x), float(z), float(w), int(w > 8)) for i, (x, z, w) in enumerate(zip(a, b, y))],
                                  "id int, a double, b double, y double, c int").repartition(3)
    return frame.cache()


def predictions(scored):
    return {r["id"]: r["prediction"] for r in scored.collect()}


@pytest.mark.parametrize("y", ["y", "c"])
def test_boosting_over_cells_equals_boosting_over_rows(spark, rows, y, tmp_path):
    estimator = M.gbt_regressor("y", rounds=3, depth=3) if y == "y" else M.gbt_classifier("c", rounds=3, depth=3)
    twice = rows.union(rows)
    plain = predictions(estimator.fit(M.assemble(twice, ["a", "b"], [y])).transform(M.assemble(rows, ["a", "b"], ["id", y])))
    model, scored = M.fit_score(estimator, twice, rows, y, ["a", "b"], ["id"])
    assert predictions(scored) == pytest.approx(plain)
    again = M.score_binned(M.saved(model, str(tmp_path / "m")), rows, ["a", "b"], ["id"])
    assert predictions(again) == pytest.approx(plain)


def test_rounds_read_cells_instead_of_rows(spark, monkeypatch):
    """1,200 rows with 12 different bins: the trees get 12 weighted rows; missing features are left out."""
    rows = spark.range(1200).select((F.col("id") % 4).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"), F.col("id").cast("double").alias("y"))
    rows = rows.union(spark.createDataFrame([(None, 1.0, 1e9)], rows.schema))
    seen = []
    fit = M.GBTRegressor.fit
    monkeypatch.setattr(M.GBTRegressor, "fit", lambda self, data: seen.append((data.count(), data.agg(F.sum("weight")).first()[0])) or fit(self, data))
    M.fit_binned(M.gbt_regressor("y", rounds=1, depth=2), rows, "y", ["a", "b"])
    assert seen == [(12, 1200.0)]


def test_bins_of_large_tables_and_odd_features(spark, monkeypatch):
    monkeypatch.setattr(M, "WHOLE", 10)
    rows = spark.range(1000).select((F.col("id") % 500).cast("double").alias("a"), F.lit(3.0).alias("flat"), F.lit(float("nan")).alias("nan"), (F.col("id") % 2).cast("double").alias("two"))
    edges = M.bin_edges(rows, ["a", "flat", "nan", "two"])
    assert 28 <= len(edges[0]) <= 31 and np.all(np.diff(edges[0]) > 0) and edges[3] == [0.5]
    model = M.fit_binned(M.gbt_regressor("two", rounds=1, depth=1), rows, "two", ["a", "flat"])
    assert M.score_binned(model, rows, ["a", "flat"], ["two"]).count() == 1000


def test_a_forest_is_dealt_out_by_rows_times_trees(spark, rows, monkeypatch):
    class Forest:
        def getNumTrees(self):
            return 300

        def fit(self, data):
            return data.rdd.getNumPartitions(), data.count()
    data = M.assemble(rows.coalesce(1), ["a", "b"], ["y"])
    assert M.fit_forest(Forest(), data)[1] == 800                    # 240,000 draws stay as they come
    monkeypatch.setattr(M, "DRAWS", 60_000)
    assert M.fit_forest(Forest(), data) == (4, 800)
    monkeypatch.setattr(M, "DRAWS", 30_000)
    assert M.fit_forest(Forest(), data) == (8, 800)
