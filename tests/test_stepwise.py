import numpy as np
import pytest
from pyspark.ml.regression import GeneralizedLinearRegression

from brambling.operators import models as M, passes, stepwise as W


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 5)) * [1, 100, .01, 1, 1] + [0, 1e6, 5, 0, 0]
    x[:, 3] += x[:, 0]                        # leans on the first
    p = 1 / (1 + np.exp(-(1.2 * x[:, 0] - 120 * (x[:, 2] - 5) + .3)))
    y = (rng.random(400) < p).astype(int)
    data = [(int(a), *map(float, r), 7.0, None if i % 50 == 3 else 1.0 * (i % 3)) for i, (a, r) in enumerate(zip(y, x))]
    return spark.createDataFrame(data, "y int, a double, b double, c double, d double, e double, same double, gap double")


def loop(df, features, level):
    """A fit per candidate and step by the built-in generalised linear model."""
    fit = lambda cols: GeneralizedLinearRegression(family="binomial", labelCol="y", maxIter=50, tol=1e-12).fit(M.assemble(df, cols, ["y"])).summary.pValues
    df, chosen = df.select("y", *features).na.drop(), []
    while len(chosen) < len(features):
        trials = {f: fit([*chosen, f])[len(chosen)] for f in features if f not in chosen}
        best = min(trials, key=lambda f: (trials[f], features.index(f)))
        if not trials[best] < level:
            break
        chosen.append(best)
    left = list(features)
    while left:
        p = fit(left)[:len(left)]
        worst = int(np.argmax(p))
        if p[worst] < level:
            break
        left.pop(worst)
    return chosen, left


def test_equals_a_fit_per_candidate(spark, frame):
    features = ["e", "a", "c"]
    want = loop(frame, features, 0.05)
    assert (M.forward_select(frame, "y", features), M.backward_eliminate(frame, "y", features)) == want
    assert want[0][:2] == ["a", "c"] or want[0][:2] == ["c", "a"]


def test_p_values_are_those_of_the_built_in_model(spark, frame):
    rows, n, varying = W._rows(frame, "y", ["a", "b", "c"])
    model = W.Logit([0, 1, 2], np.zeros(4))
    assert W.fit_logits(rows, [model]) < 15 and n == 400 and varying == [0, 1, 2]
    built = GeneralizedLinearRegression(family="binomial", labelCol="y", maxIter=50, tol=1e-12).fit(M.assemble(frame, ["a", "b", "c"], ["y"])).summary
    assert model.p[:3] == pytest.approx(built.pValues[:3], rel=1e-5, abs=1e-12) and model.deviance == pytest.approx(built.deviance)


def test_jobs_grow_with_steps_only(spark, frame, monkeypatch):
    """Eight candidates are fitted in as many passes as one takes at most."""
    calls = []
    monkeypatch.setattr(W, "sums_by_model", lambda rows, models, work: (calls.append(len(models)), passes.sums_by_model(rows, models, work))[1])
    rows, _, _ = W._rows(frame, "y", ["a", "b", "c", "d", "e"])
    many = [W.Logit([k], np.zeros(2)) for k in range(5)]
    W.fit_logits(rows, many)
    assert calls[0] == 5 and len(calls) < 15 and all(m.settled for m in many)
    calls.clear()
    W.fit_logits(rows, [W.Logit([k], np.zeros(2)) for k in range(5)], pass_bytes=1)
    assert set(calls) == {1}


def test_constant_columns_and_no_rows(spark, frame):
    assert "same" not in M.forward_select(frame, "y", ["same", "a"]) and "same" not in M.backward_eliminate(frame, "y", ["same", "a"])
    assert M.forward_select(frame.limit(0), "y", ["a"]) == [] and M.forward_select(frame, "y", ["same"]) == []
