from pyspark.sql import functions as F

from brambling.operators import encode
from brambling.plans import prepare


def test_many_categories_become_positions(spark):
    """No number of categories is refused; few ones stay columns."""
    rows = [(i, f"c{i % 37:02}", "xyz"[i % 3], float(i % 5), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, wide string, few string, v double, y int")
    few, positions = encode.fit_categories(df, ["wide", "few"], limit=10)
    assert few == {"few": ["x", "y", "z"]}
    assert sorted(map(tuple, positions.collect())) == [("wide", f"c{k:02}", k - 1) for k in range(1, 37)]
    new = spark.createDataFrame([(1, "c00"), (2, "c36"), (3, None), (4, "unseen")], "id int, wide string")
    hot = encode.sparse_dummies(new, positions)
    assert {r["id"]: r["hot"] for r in hot.collect()} == {1: [], 2: [35], 3: [], 4: []}
    vectors = {r["id"]: r["features"] for r in encode.hot_vector(hot, 36).collect()}
    assert vectors[2].size == 36 and vectors[2].indices.tolist() == [35] and vectors[1].numNonzeros() == 0


def test_a_preparation_with_a_wide_column_is_saved_and_applied(spark, tmp_path, monkeypatch):
    rows = [(i, f"c{i % 37:02}", "xyz"[i % 3], float(i % 5), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, wide string, few string, v double, y int")
    monkeypatch.setattr(encode.fit_categories, "__defaults__", (10,))
    recipe = prepare.Recipe(keep=("id", "y"), target="y", numeric=("v",), categorical=("wide", "few"))
    fitted = prepare.fit(recipe, df)
    out = fitted.apply(df)
    assert out.columns == ["id", "y", "v", "hot", "few_y", "few_z"]
    assert {r["id"]: r["hot"] for r in out.collect()} == {i: [i % 37 - 1] if i % 37 else [] for i in range(200)}
    fitted.save(spark, str(tmp_path / "fit"))
    again = prepare.load(spark, recipe, str(tmp_path / "fit")).apply(df)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, out.collect()), key=str)


def test_positions_of_several_columns_follow_each_other(spark):
    df = spark.createDataFrame([("a", 2), ("b", 1), ("c", None), (None, 3)], "s string, n int")
    got = [tuple(r) for r in encode.fit_positions(df, ["s", "n"]).orderBy("position").collect()]
    assert got == [("s", "b", 0), ("s", "c", 1), ("n", "2", 2), ("n", "3", 3)]
    hot = encode.sparse_dummies(df, encode.fit_positions(df, ["s", "n"])).select("s", "hot")
    assert {r["s"]: r["hot"] for r in hot.collect()} == {"a": [2], "b": [0], "c": [1], None: [3]}
    assert encode.fit_positions(df.limit(0), ["s"]).count() == 0
