"""Gaussian mixtures by expectation maximisation, many models at once.

Every (number of components, start) is a model.  One pass over the rows serves all models that are still moving:
a task adds up each model's log-likelihood, responsibilities and first and second moments over its rows, the sums of
the tasks meet by model, and the new parameters are worked out from them on the driver.  Models whose mean
log-likelihood stands still drop out of the next pass.  What travels in one pass, to and from the tasks, is bounded
by ``PASS_BYTES``; more models than that are dealt to several passes.

Starts come from a sample of at most ``SAMPLE`` rows (k-means++ seeds, a few rounds of k-means, the spread inside the
clusters); all rounds run over all rows.  Rows that hold no vector, or a missing or non-finite component, are left
out.  Vectors have one length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from brambling.operators.passes import PASS_BYTES, dealt, sums_by_model
from brambling.session import settle

SAMPLE = 2_000
ROUNDS, STARTS, TOLERANCE, RIDGE = 100, 10, 1e-3, 1e-6


@dataclass
class Mixture:
    """Weights (k), means (k, d) and covariances (k, d, d); ``likelihood`` is that of the rows under them."""
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    start: int = 0
    likelihood: float = -math.inf
    settled: bool = False

    @property
    def k(self) -> int:
        return len(self.weights)

    @property
    def parameters(self) -> int:
        d = self.means.shape[1]
        return self.k * (d + d * (d + 1) // 2) + self.k - 1

    def factors(self) -> tuple[np.ndarray, ...]:
        """What a task needs: constants, means and the inverted factors of the covariances."""
        lower = np.linalg.cholesky(self.covariances)
        constant = np.log(self.weights) - np.log(np.diagonal(lower, axis1=1, axis2=2)).sum(1) - self.means.shape[1] / 2 * math.log(2 * math.pi)
        return constant, self.means, np.linalg.inv(lower)


def log_densities(x: np.ndarray, factors: tuple[np.ndarray, ...]) -> np.ndarray:
    """(k, rows) logarithms of each component's weighted density."""
    constant, means, inverse = factors
    y = np.matmul(x[None] - means[:, None], inverse.transpose(0, 2, 1))
    return constant[:, None] - 0.5 * np.einsum("knd,knd->kn", y, y)


def moments(x: np.ndarray, factors: tuple[np.ndarray, ...]) -> np.ndarray:
    """Log-likelihood, then per component the responsibility, its first and its second moments, in one row of numbers."""
    dense = log_densities(x, factors)
    most = dense.max(0)
    whole = most + np.log(np.exp(dense - most).sum(0))
    r = np.exp(dense - whole)
    second = np.matmul(r[:, None, :] * x.T[None], x)
    return np.concatenate([[whole.sum()], r.sum(1), (r @ x).ravel(), second.ravel()])


def improved(model: Mixture, sums: np.ndarray, n: int, ridge: float) -> Mixture:
    """The model that the sums of one pass lead to; its likelihood is not known yet."""
    k, d = model.means.shape
    share = sums[1:1 + k] + 10 * np.finfo(float).eps
    means = sums[1 + k:1 + k + k * d].reshape(k, d) / share[:, None]
    second = sums[1 + k + k * d:].reshape(k, d, d) / share[:, None, None]
    spread = second - means[:, :, None] * means[:, None, :]
    return Mixture(share / share.sum(), means, positive((spread + spread.transpose(0, 2, 1)) / 2, ridge), model.start)


def positive(spread: np.ndarray, ridge: float) -> np.ndarray:
    """Covariances with ``ridge`` on the diagonal; where rounding has made a spread negative it counts as 0."""
    covariances = spread + ridge * np.eye(spread.shape[-1])
    try:
        np.linalg.cholesky(covariances)
    except np.linalg.LinAlgError:
        values, axes = np.linalg.eigh(spread)
        covariances = np.matmul(axes * (np.maximum(values, 0) + ridge)[:, None, :], axes.transpose(0, 2, 1))
    return covariances


def first_guess(sample: np.ndarray, k: int, start: int, ridge: float = RIDGE) -> Mixture:
    """Seeds far apart, five rounds of k-means, and the pooled spread inside the clusters."""
    rng = np.random.default_rng([k, start])
    centres = sample[[rng.integers(len(sample))]]
    for _ in range(k - 1):
        far = ((sample[:, None] - centres[None]) ** 2).sum(2).min(1)
        centres = np.vstack([centres, sample[rng.choice(len(sample), p=far / far.sum()) if far.sum() > 0 else rng.integers(len(sample))]])
    for _ in range(5):
        near = ((sample[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        count = np.bincount(near, minlength=k)
        total = np.stack([np.bincount(near, sample[:, j], k) for j in range(sample.shape[1])], 1)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    inside = sample - centres[near]
    spread = inside.T @ inside / len(sample) + ridge * np.eye(sample.shape[1])
    return Mixture((count + 1) / (count + 1).sum(), centres, np.repeat(spread[None], k, 0), start)


def _vectors(vectors: DataFrame, column: str) -> DataFrame:
    """One array column ``x`` of the usable rows, and nothing else."""
    from pyspark.ml.functions import vector_to_array
    kind = vectors.schema[column].dataType.typeName()
    x = vector_to_array(column) if kind == "vector" or "udt" in kind.lower() else F.col(column).cast("array<double>")
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return vectors.select(x.alias("x")).filter((F.size("x") > 0) & ~bad)


def fit_mixtures(vectors: DataFrame, ks: list[int], starts: int = STARTS, rounds: int = ROUNDS, tolerance: float = TOLERANCE, ridge: float = RIDGE,
                 column: str = "features", sample_rows: int = SAMPLE, pass_bytes: int = PASS_BYTES) -> tuple[dict[int, Mixture], int]:
    """The likeliest of ``starts`` models for every k after at most ``rounds`` rounds, and the number of rows.

    A model ends when its mean log-likelihood changes by less than ``tolerance`` in a round.  No usable row: no models.
    """
    rows = settle(_vectors(vectors, column))
    n = rows.count()
    if not n:
        return {}, 0
    d = rows.select(F.size("x").alias("d")).first()["d"]
    shift = np.array(rows.agg(*[F.avg(F.col("x")[j]).alias(f"m{j}") for j in range(d)]).first(), float)
    # the rate keeps what the tasks send near the size of the sample
    part = rows if n <= 2 * sample_rows else rows.filter(F.pmod(F.xxhash64("x"), F.lit(1_000_000)) < math.ceil(2e6 * sample_rows / n))
    sample = np.array([r["x"] for r in part.orderBy(F.xxhash64("x"), "x").limit(sample_rows).collect()]) - shift
    models = [first_guess(sample, k, s, ridge) for k in ks for s in range(1 if k == 1 else starts)]
    for turn in range(rounds + 1):
        moving = {i: m for i, m in enumerate(models) if not m.settled}
        for wave in dealt(moving, lambda m: 1 + m.k * (1 + d + d * d), pass_bytes):
            given = {i: (shift, m.factors()) for i, m in wave.items()}
            for i, sums in sums_by_model(rows, given, lambda x, g: moments(x - g[0], g[1])).items():
                before, models[i].likelihood = models[i].likelihood, float(sums[0])
                if turn == rounds or abs(models[i].likelihood - before) < tolerance * n:
                    models[i].settled = True
                else:
                    better = improved(models[i], sums, n, ridge)
                    better.likelihood = models[i].likelihood
                    models[i] = better
    best = {}
    for m in models:
        if m.k not in best or m.likelihood > best[m.k].likelihood:
            best[m.k] = m
    for m in best.values():
        m.means = m.means + shift
    return best, n


def curves(vectors: DataFrame, ks: list[int], starts: int = STARTS, rounds: int = ROUNDS, **options) -> DataFrame:
    """(k, log_likelihood, aic, bic) of the best model for every k."""
    best, n = fit_mixtures(vectors, ks, starts, rounds, **options)
    rows = [(k, m.likelihood, 2.0 * m.parameters - 2 * m.likelihood, m.parameters * math.log(n) - 2 * m.likelihood) for k, m in best.items()]
    return vectors.sparkSession.createDataFrame(rows, "k int, log_likelihood double, aic double, bic double")


def assign(vectors: DataFrame, model: Mixture, column: str = "features", name: str = "component", probability: str = "probability") -> DataFrame:
    """Every row with its likeliest component (numbered from 0) and that component's probability; null where there is no usable vector."""
    from pyspark.ml.functions import vector_to_array
    factors = model.factors()
    kind = vectors.schema[column].dataType.typeName()
    x = vector_to_array(column) if kind == "vector" or "udt" in kind.lower() else F.col(column).cast("array<double>")

    @F.pandas_udf(f"struct<{name}:int,{probability}:double>")
    def likeliest(values):
        import pandas as pd
        d = factors[1].shape[1]
        good = np.array([v is not None and len(v) == d and bool(np.all(np.isfinite(np.asarray(v, float)))) for v in values], bool)
        best, sure = np.full(len(values), None, object), np.full(len(values), np.nan)
        if good.any():
            dense = log_densities(np.array([np.asarray(v, float) for v in values[good]]), factors)
            best[good] = dense.argmax(0)
            sure[good] = 1 / np.exp(dense - dense.max(0)).sum(0)
        return pd.DataFrame({name: pd.array(best, "Int32"), probability: sure})

    found = vectors.withColumn("_found", likeliest(x))
    return found.select(*vectors.columns, f"_found.{name}", F.when(F.col(f"_found.{name}").isNotNull(), F.col(f"_found.{probability}")).alias(probability))
