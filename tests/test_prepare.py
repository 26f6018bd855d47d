import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brambling.operators import encode, models as M
from brambling.plans import prepare, recipes
from brambling.plans.prepare import Recipe
from brambling.session import new_path


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(2)
    n = 600
    pdf = pd.DataFrame({"id": range(n), "town": rng.choice(list("pqr"), n), "kind": rng.choice(["u", "v", None], n),
                        "x": rng.normal(size=n), "flat": 4.0, "z": rng.uniform(size=n)})
    pdf["y"] = 3 + 2 * pdf.x - 5 * pdf.z
    pdf["label"] = (rng.uniform(size=n) < 1 / (1 + np.exp(-(2 * pdf.x)))).astype(int)
    gaps = pdf.assign(x=pdf.x.where(pdf.id % 6 != 0))
    df = spark.createDataFrame(gaps).withColumn("x", F.nanvl("x", F.lit(None)))
    return pdf, gaps, df


RECIPE = Recipe(keep=("id", "y"), target="y", numeric=("x", "flat", "town_code"), categorical=("kind",), ordinal=("town",), impute=("x", "town_code"))


def test_fit_and_apply(people):
    _, gaps, df = people
    train, test = df.filter("id < 400"), df.filter("id >= 400").withColumn("town", F.when(F.col("id") == 500, "new").otherwise(F.col("town")))
    fitted = prepare.fit(RECIPE, train)
    out = fitted.apply(test).toPandas().set_index("id")
    part = gaps[gaps.id < 400]
    lo, hi, mid = part.x.min(), part.x.max(), part.x.median()
    want = (gaps[gaps.id >= 400].set_index("id").x.fillna(mid) - lo) / (hi - lo)
    assert np.allclose(out.x.sort_index(), want.sort_index())
    assert (out.flat == 0).all()                        # a constant column gives 0
    assert list(out.columns)[-1:] == ["kind_v"]         # first category dropped, of the training rows
    order = part.groupby("town").y.mean().sort_values().index.tolist()
    codes = {r.town: r.town_code for r in fitted.codes["town_code"].collect()}
    assert codes == {t: i for i, t in enumerate(order)}
    assert out.loc[500, "town_code"] == 0.5             # unseen: null, then the median of the codes 0, 1, 2 scaled


def test_saved_fit_gives_the_same_rows(people, spark):
    df = people[2]
    fitted = prepare.fit(RECIPE, df)
    path = new_path(spark, "fit")
    fitted.save(spark, path)
    a, b = fitted.apply(df), prepare.load(spark, RECIPE, path).apply(df)
    assert a.exceptAll(b.select(a.columns)).isEmpty() and a.count() == b.count()


def test_limits_come_before_the_medians(spark):
    rows = [(i, "F" if i % 2 else "O", float(i * 100_000), float(i), "s", i % 2, "1-URGENT") for i in range(1, 20)]
    df = spark.createDataFrame(rows, "loan_id int, loan_status string, amount double, balance double, segment string, nation int, priority string")
    df = df.withColumn("issued", F.lit("2019-05-01").cast("timestamp_ntz"))
    assert prepare.fit(recipes.credit_limited(), df).medians["amount"] == 400_000.0
    assert prepare.fit(recipes.credit(), df).medians["amount"] == 1_000_000.0


def test_iterative_impute_recovers_a_linear_column(people, spark):
    pdf, gaps, df = people
    out = M.iterative_impute(df, ["x", "z", "y"]).toPandas().set_index("id").x.sort_index()
    assert np.allclose(out, pdf.x, atol=1e-6)


def test_known_coefficients(people, spark):
    df = spark.createDataFrame(people[0])
    est = {r.term: r.estimate for r in M.ols(df, "y", ["x", "z"]).collect()}
    assert est == pytest.approx({"x": 2.0, "z": -5.0, "const": 3.0})


def test_selection_keeps_the_column_that_matters(people, spark):
    df = spark.createDataFrame(people[0]).withColumn("noise", F.rand(3))
    assert M.forward_select(df, "label", ["noise", "x"], 0.001) == ["x"]
    assert M.backward_eliminate(df, "label", ["noise", "x"], 0.001) == ["x"]


def test_components_and_singular_values(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(120, 5)) @ np.diag([4, 3, 2, 1, .1]) + 7
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, v array<double>")
    vectors = M.assemble_array(df, "v", ["id"])
    scores, ratios = M.principal_components(vectors, share=0.9)
    got = np.array([r.scores for r in scores.orderBy("id").collect()])
    _, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    share = s ** 2 / (s ** 2).sum()
    k = int(np.nonzero(np.cumsum(share) >= .9)[0][0]) + 1
    assert got.shape[1] == k and np.allclose(ratios, share[:k])
    assert np.allclose(np.abs(got), np.abs((x - x.mean(0)) @ vt[:k].T))
    values, low = M.singular_values(vectors, 3)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(values, s[:3])
    assert np.allclose(np.abs(np.array([r.scores for r in low.orderBy("id").collect()])), np.abs(u[:, :3] * s[:3]))


def test_single_gaussian_and_single_cluster(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3)) * [1, 2, 3]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, v array<double>")
    vectors = M.assemble_array(df, "v", ["id"])
    assert M.elbow(vectors, [1, 2]).collect()[0].cost == pytest.approx(((x - x.mean(0)) ** 2).sum())
    one = M.gaussian_mixtures(vectors, [1]).first()
    cov, d = np.cov(x.T, bias=True), x - x.mean(0)
    ll = -.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1] + 3 * np.log(2 * np.pi)).sum()
    assert one.log_likelihood == pytest.approx(ll) and one.aic == pytest.approx(18 - 2 * ll)


def test_index_ids_are_dense(spark):
    df = spark.createDataFrame([(7,), (3,), (7,), (None,), (11,)], "item int")
    assert {r["item"]: r["index"] for r in encode.index_ids(df, "item").collect()} == {3: 0, 7: 1, 11: 2}
