import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brambling.operators import ordering as O, split


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": range(900), "g": ["hot"] * 600 + list(rng.choice(list("abc"), 300)),
                        "v": np.round(rng.normal(size=900), 1)})
    pdf.loc[pdf.id % 9 == 0, "v"] = 0.5
    pdf.loc[pdf.id % 50 == 7, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))
    return pdf, df


def test_blocks_are_several(skewed):
    assert O.sorted_blocks(skewed[1], ["id"]).select("_block").distinct().count() > 1


def test_row_numbers(skewed):
    pdf, df = skewed
    got = O.number_rows(df, ["id"], "rn", ["g"]).select("id", "rn").toPandas().set_index("id").rn
    want = pdf.sort_values("id").groupby("g").cumcount() + 1
    assert got.sort_index().tolist() == want.tolist()
    assert sorted(r.rn for r in O.number_rows(df, ["id"], "rn").select("rn").collect()) == list(range(1, 901))


def test_running_sums(skewed):
    pdf, df = skewed
    got = O.running_sums(df, ["id"], {"s": F.coalesce("v", F.lit(0.0))}, ["g"]).select("id", "s").toPandas().set_index("id").s
    want = pdf.assign(v=pdf.v.fillna(0)).groupby("g").v.cumsum()
    assert np.allclose(got.sort_index().to_numpy(), want.to_numpy())


@pytest.mark.parametrize("by", [None, ["g"]])
@pytest.mark.parametrize("accuracy", [10_000, 200])
def test_quantiles(skewed, by, accuracy, monkeypatch):
    """Brackets hold the quantile of large groups, small groups are ranked whole: no second ranking is needed."""
    pdf, df = skewed
    monkeypatch.setattr(O, "_ranked_quantiles", None)
    probs = [0.0, .1, .25, .5, .9, 1.0]
    rows = O.exact_quantiles(df, ["v", "id"], probs, by, accuracy).collect()
    for row in rows:
        part = pdf if by is None else pdf[pdf.g == row["g"]]
        assert row["quantile"] == pytest.approx(part[row["column"]].quantile(row["prob"]))
    assert len(rows) == 2 * len(probs) * (1 if by is None else pdf.g.nunique())


def test_folds_are_consecutive(skewed):
    df = skewed[1].select("id")
    folds = split.consecutive_folds(df, ["id"], 7).toPandas().sort_values("id").fold
    sizes = folds.value_counts().sort_index().tolist()
    assert sizes == [129] * 4 + [128] * 3 and folds.is_monotonic_increasing
    assert sorted(split.consecutive_folds(df.filter("id < 3"), ["id"], 5).toPandas().fold) == [0, 1, 2]


def test_stratified_split_keeps_shares(skewed):
    pdf, df = skewed
    out = split.stratified_split(df, "id", "g").groupBy("g").agg(F.avg(F.col("is_test").cast("int")).alias("s"), F.count("*").alias("n")).collect()
    for row in out:
        assert row["s"] == pytest.approx(int(row["n"] * .2) / row["n"])


def test_top_k_per_group_limits_before_the_shuffle(skewed):
    df = O.top_k_per_group(skewed[1], ["g"], ["id"], 3)
    assert df.groupBy("g").count().filter("count <> 3").isEmpty()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_large_limits_and_samples_are_exact(skewed, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr(O, "FEW", 10)
    assert sorted(r.id for r in O.top_k(df, [F.desc("id")], 25).collect()) == list(range(875, 900))
    assert O.top_k_per_group(df, ["g"], ["id"], 20).groupBy("g").count().filter("count <> 20").isEmpty()
    whole = [r.id for r in df.select("id", split.C.hash_number(F.col("id")).alias("h")).orderBy("h", "id").limit(50).collect()]
    assert sorted(r.id for r in split.sample_rows(df, "id", 50).collect()) == sorted(whole)
    assert split.sample_rows(df, "id", 5000).count() == 900


def test_quantiles_survive_a_bracket_that_misses(skewed, monkeypatch):
    pdf, df = skewed
    keys = ["column"]
    full = O._ranked_quantiles(O._melted(df, ["v"], []), keys, [.5, .9]).collect()
    for row in full:
        assert row["quantile"] == pytest.approx(pdf.v.quantile(row["prob"]))
    coarse = O.exact_quantiles(df, ["v", "id"], [.25, .5], accuracy=3).collect()
    for row in coarse:
        assert row["quantile"] == pytest.approx(pdf[row["column"]].quantile(row["prob"]))
