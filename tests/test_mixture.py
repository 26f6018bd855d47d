import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brambling.operators import mixture as X, models as M


def em(x, model, rounds, tolerance, ridge=X.RIDGE):
    """Plain expectation maximisation of one model over all rows at once."""
    w, mu, cov = model.weights, model.means, model.covariances
    before = -math.inf
    for turn in range(rounds + 1):
        dense = np.stack([math.log(w[j]) - .5 * (np.einsum("ni,ij,nj->n", x - mu[j], np.linalg.inv(cov[j]), x - mu[j])
                          + np.linalg.slogdet(cov[j])[1] + x.shape[1] * math.log(2 * math.pi)) for j in range(len(w))])
        whole = np.logaddexp.reduce(dense, 0)
        likelihood = whole.sum()
        if turn == rounds or abs(likelihood - before) < tolerance * len(x):
            return likelihood, turn
        before, r = likelihood, np.exp(dense - whole)
        n = r.sum(1)
        w, mu = n / n.sum(), (r @ x) / n[:, None]
        cov = np.stack([((x - mu[j]) * r[j][:, None]).T @ (x - mu[j]) / n[j] + ridge * np.eye(x.shape[1]) for j in range(len(w))])


def rows_of(spark, x, parts=3):
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, v array<double>").repartition(parts)
    return M.assemble_array(df, "v", ["id"])


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(2)
    return np.vstack([rng.normal(size=(120, 2)) * [1, .3] + [0, 4], rng.normal(size=(90, 2)) * .5 + 1000, rng.normal(size=(60, 2)) + [5, -3]])


def test_equals_plain_em(spark, blobs):
    """Every start of every k, over rows that lie far from the origin in several partitions."""
    ks, starts, rounds = [1, 2, 3, 5], 3, 25
    best, n = X.fit_mixtures(rows_of(spark, blobs), ks, starts, rounds)
    shift = blobs.mean(0)
    assert n == len(blobs)
    sample = np.array(sorted_sample(spark, blobs)) - shift
    for k in ks:
        runs = [em(blobs - shift, X.first_guess(sample, k, s), rounds, X.TOLERANCE)[0] for s in range(1 if k == 1 else starts)]
        assert best[k].likelihood == pytest.approx(max(runs), rel=1e-7)


def sorted_sample(spark, x):
    df = rows_of(spark, x)
    return [r["x"] for r in X._vectors(df, "features").orderBy(F.xxhash64("x"), "x").collect()]


def test_passes_are_bounded_and_change_nothing(spark, blobs):
    vectors = rows_of(spark, blobs)
    one = X.fit_mixtures(vectors, [2, 3], 2, 10)[0]
    many = X.fit_mixtures(vectors, [2, 3], 2, 10, pass_bytes=200)[0]
    deal = lambda limit: [list(w) for w in X.dealt(dict.fromkeys(range(4)), lambda m: 10, limit)]
    assert deal(79) == [[0], [1], [2], [3]] and deal(160) == [[0, 1], [2, 3]] and deal(10**6) == [[0, 1, 2, 3]] and X.dealt({}, len) == []
    assert all(one[k].likelihood == pytest.approx(many[k].likelihood) for k in one)


def test_criteria_pick_the_blobs(spark, blobs):
    table = {r["k"]: r for r in X.curves(rows_of(spark, blobs), [1, 2, 3, 4], 4, 60).collect()}
    assert min(table, key=lambda k: table[k]["bic"]) == 3
    d, n = 2, len(blobs)
    for k, r in table.items():
        p = k * (d + d * (d + 1) / 2) + k - 1
        assert r["aic"] == pytest.approx(2 * p - 2 * r["log_likelihood"]) and r["bic"] == pytest.approx(p * math.log(n) - 2 * r["log_likelihood"])


def test_rows_find_their_component(spark, blobs):
    vectors = rows_of(spark, blobs)
    model = X.fit_mixtures(vectors, [3], 4, 60)[0][3]
    got = {r["id"]: r for r in X.assign(vectors, model).collect()}
    groups = [{got[i]["component"] for i in part} for part in (range(120), range(120, 210), range(210, 270))]
    assert all(len(g) == 1 for g in groups[:2]) and len(set.union(*groups)) == 3
    assert all(.3 < r["probability"] <= 1.0000001 for r in got.values())


def test_unusable_rows_and_few_distinct_ones(spark):
    data = [(0, None), (1, []), (2, [1.0, None]), (3, [float("nan"), 1.0]), *[(i, [1.0, 2.0]) for i in range(4, 30)]]
    df = spark.createDataFrame(data, "id int, features array<double>")
    best, n = X.fit_mixtures(df, [1, 2], 2, 5)
    assert n == 26 and all(math.isfinite(m.likelihood) for m in best.values())
    assert X.fit_mixtures(df.limit(0), [1, 2])[0] == {} and X.curves(df.limit(0), [1]).count() == 0
    assert {r["id"] for r in X.assign(df, best[1]).collect() if r["component"] is None} == {0, 1, 2, 3}


def test_a_spread_made_negative_by_rounding_is_mended():
    spread = np.array([np.eye(2), [[1.0, 2.0], [2.0, 1.0]]])
    mended = X.positive(spread, 1e-6)
    assert np.allclose(mended[0], np.eye(2), atol=1e-5) and np.linalg.eigvalsh(mended[1])[0] > 0
    assert np.array_equal(X.positive(spread[:1], 1e-6), spread[:1] + 1e-6 * np.eye(2))
