import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brambling.operators import evaluate as E, explore as X


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"g": rng.choice(["x", "y"], 500, p=[.8, .2]), "a": rng.normal(10, 3, 500), "b": rng.exponential(2, 500)})
    pdf["c"] = pdf.a * 2 + rng.normal(0, 1, 500)
    return pdf, spark.createDataFrame(pdf)


def test_moments(frame):
    pdf, df = frame
    for row in X.shape_moments(df, ["a", "b"]).collect():
        assert row.skewness == pytest.approx(pdf[row.column].skew()) and row.kurtosis == pytest.approx(pdf[row.column].kurt())


def test_vif(frame):
    pdf, df = frame
    x = pdf[["a", "b", "c"]].to_numpy()
    for row in X.vif(df, ["a", "b", "c"]).collect():
        i = "abc".index(row.column)
        others = np.delete(x, i, axis=1)
        fit = others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        assert row.vif == pytest.approx((x[:, i] ** 2).sum() / ((x[:, i] - fit) ** 2).sum())


def test_density_is_the_kernel_sum(frame):
    pdf, df = frame
    rows = X.density(df, "g", "a", points=16, bins=20_000).toPandas()
    for g, part in rows.groupby("g"):
        v = pdf[pdf.g == g].a.to_numpy()
        h = v.std(ddof=1) * len(v) ** -.2
        want = [np.exp(-((x - v) / h) ** 2 / 2).sum() / (len(v) * h * np.sqrt(2 * np.pi)) for x in part.x]
        assert np.allclose(part.density, want, atol=1e-4)


def test_normal_quantiles(spark):
    p = [0.001, 0.025, 0.2, 0.5, 0.8, 0.975, 0.999]
    want = [-3.090232306, -1.959963985, -0.841621234, 0.0, 0.841621234, 1.959963985, 3.090232306]
    got = spark.createDataFrame([(x,) for x in p], "p double").select(X.normal_quantile(F.col("p"))).collect()
    assert np.allclose([r[0] for r in got], want, atol=1e-7)


def test_qq_points_follow_the_rank(frame, spark):
    pdf, df = frame
    keyed = spark.createDataFrame(pdf.reset_index())
    out = X.qq_points(keyed, "a", "index").toPandas().sort_values("value")
    assert out.theoretical.is_monotonic_increasing and len(out) == 500
    assert out.theoretical.iloc[0] == pytest.approx(-out.theoretical.iloc[-1])


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(4)
    p = np.round(rng.beta(2, 3, 800), 2)
    p[:6] = [0.0, 1.0, 0.29, 0.57, 0.58, 0.99]
    pdf = pd.DataFrame({"y": (rng.uniform(size=800) < p).astype(int), "p": p})
    return pdf, spark.createDataFrame(pdf)


def test_auc_counts_pairs(scores):
    pdf, df = scores
    a, b = pdf[pdf.y == 1].p.to_numpy()[:, None], pdf[pdf.y == 0].p.to_numpy()[None, :]
    assert E.roc_auc(df, "y", "p").first().auc == pytest.approx(((a > b) + .5 * (a == b)).mean())


def test_threshold_sweep_at_the_borders(scores):
    pdf, df = scores
    for row in E.threshold_sweep(df, "y", "p").collect():
        called = pdf.p > row.threshold
        tp, fp = (called & (pdf.y == 1)).sum(), (called & (pdf.y == 0)).sum()
        assert row.precision_1 == pytest.approx(tp / (tp + fp) if tp + fp else 0)
        assert row.recall_1 == pytest.approx(tp / (pdf.y == 1).sum())
        assert row.recall_0 == pytest.approx(1 - fp / (pdf.y == 0).sum())


def test_undefined_rates_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, yhat int")
    report = {r.label: r for r in E.classification_report(df, "y", "yhat", [0, 1]).collect()}
    assert report["1"].precision == report["1"].f1 == 0.0 and report["0"].recall == 1.0
    assert report["accuracy"].f1 == pytest.approx(2 / 3)
