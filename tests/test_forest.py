import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from brambling.operators import forest, models as M
from brambling.session import new_path, settle

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = np.stack([rng.normal(0, 1, 3000), rng.integers(0, 2, 3000), rng.integers(0, 5, 3000)], 1)
    y = np.sin(2 * x[:, 0]) * 3 + x[:, 0] * x[:, 1] + .3 * x[:, 2] + rng.normal(0, .3, 3000)
    return spark.createDataFrame([(i, *map(float, v), float(w), int(w > 1) + int(w > 3)) for i, (v, w) in enumerate(zip(x, y))],
                                 "id int, a double, b double, c double, y double, k int").repartition(5).cache()


def estimators(y):
    return M.forest_regressor("y", trees=25, features="2", depth=5, min_leaf=5) if y == "y" else M.forest_classifier("k", trees=25, depth=5, min_leaf=5)


def error(scored, y):
    off = (F.col("prediction") - F.col(y)) ** 2 if y == "y" else (F.col("prediction") != F.col(y)).cast("double")
    return scored.agg(F.avg(off)).first()[0]


@pytest.mark.parametrize("y", ["y", "k"])
def test_a_large_forest_is_grown_from_packed_bins(spark, rows, y, monkeypatch, tmp_path):
    """Spark's trainer gets a few rows that stand for the shape of the model; the forest errs, and weighs the features, like its own."""
    plain, scored = M.fit_score(estimators(y), rows, rows, y, NAMES, ["id"])
    usual = error(scored, y)
    monkeypatch.setattr(M, "GROWN", 0)
    kind, seen = RandomForestRegressor if y == "y" else RandomForestClassifier, []
    fit = kind.fit
    monkeypatch.setattr(kind, "fit", lambda self, data: seen.append(data.count()) or fit(self, data))
    model, scored = M.fit_score(estimators(y), rows, rows, y, NAMES, ["id"])
    assert sum(seen) < 10 and type(model) is type(plain)
    assert error(scored, y) == pytest.approx(usual, rel=.15)
    assert model.getNumTrees == 25 and max(t.depth for t in model.trees) == 5
    assert model.featureImportances.toArray() == pytest.approx(plain.featureImportances.toArray(), abs=.08)
    again = M.saved(model, str(tmp_path / "m")).transform(M.assemble(rows, NAMES, ["id", y]))
    assert {r["id"]: r["prediction"] for r in again.collect()} == {r["id"]: r["prediction"] for r in scored.collect()}


def test_leaves_keep_enough_draws_and_missing_labels_are_refused(spark, rows, monkeypatch):
    monkeypatch.setattr(M, "GROWN", 0)
    model = M.fit_forest(M.forest_regressor("y", trees=3, depth=4, min_leaf=200), M.assemble(rows, NAMES, ["y"]))
    trees = model.toDebugString
    assert trees.count("Predict") >= 6
    path = new_path(spark, "leaves")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    assert nodes.agg(F.min("rawCount")).first()[0] >= 200
    roots = [r["rawCount"] for r in nodes.filter("id = 0").collect()]
    assert len(set(roots)) > 1 and all(abs(n - 3000) < 300 for n in roots)      # a Poisson number of draws
    gaps = M.assemble(rows.withColumn("y", F.when(F.col("id") > 5, F.col("y"))), NAMES, ["y"])
    with pytest.raises(Exception, match="[Ll]abels"):
        M.fit_forest(M.forest_regressor("y", trees=3), gaps)


@pytest.mark.parametrize("y", ["y", "k"])
def test_levels_over_rows_split_like_cells(spark, rows, y, monkeypatch):
    """Few cells or many, one chunk of rows or several: the same draws give the same splits."""
    estimator, classes = estimators(y), 0 if y == "y" else 3
    data = settle(rows.select(F.col(y).cast("double"), *NAMES))
    edges = M.bin_edges(data, NAMES)
    found = []
    for table, chunk in ((1 << 20, 8_000_000), (0, 8_000_000), (0, 700)):
        monkeypatch.setattr(forest, "TABLE", table)
        monkeypatch.setattr(forest, "CHUNK", chunk)
        found.append({x[:2]: x[2:] for x in forest.splits(estimator, data, edges, classes, 3000)})
    cells, *levels = found
    assert len(cells) > 25 * 10
    for other in levels:
        assert other.keys() == cells.keys()
        same = [other[k][:2] == cells[k][:2] for k in cells]
        assert np.mean(same) > .99          # equal gains of two splits may be told apart by rounding
        assert all(other[k][3] == pytest.approx(cells[k][3]) for k in cells if k[1] == 0)
