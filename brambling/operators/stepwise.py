"""Stepwise selection for logistic regression, with all candidates of a step fitted together.

Every candidate model is a set of columns.  One Newton round is one pass over the rows for all models that still
move: tasks add up each model's gradient, curvature and deviance, and the small systems are solved on the driver.
So the number of jobs grows with the steps, not with the candidates.  Columns are brought to mean 0 and spread 1
first, which changes no p value.

Rows with a missing value in any column are left out.  A constant column never enters (its p value is 1).  Ties go to
the column that is named first.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, functions as F

from brambling.operators.passes import PASS_BYTES, dealt, sums_by_model
from brambling.session import settle

LEVEL, ROUNDS, TOLERANCE = 0.05, 50, 1e-10


@dataclass
class Logit:
    """Columns of a model (places in the row behind the outcome), its coefficients, constant last, and p values."""
    columns: list[int]
    beta: np.ndarray
    deviance: float = math.inf
    p: np.ndarray = field(default_factory=lambda: np.empty(0))
    settled: bool = False


def newton_sums(rows: np.ndarray, model: tuple[list[int], np.ndarray]) -> np.ndarray:
    """Deviance, gradient and curvature of some rows (outcome first) in one row of numbers."""
    columns, beta = model
    y, x = rows[:, 0], np.column_stack([rows[:, [c + 1 for c in columns]], np.ones(len(rows))])
    eta = x @ beta
    mu = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
    deviance = 2 * (np.logaddexp(0, eta) - y * eta).sum()
    return np.concatenate([[deviance], x.T @ (y - mu), ((x.T * (mu * (1 - mu))) @ x).ravel()])


def _solved(model: Logit, sums: np.ndarray) -> None:
    """Take one Newton step, or settle the model and work out its p values."""
    k = len(model.beta)
    deviance, gradient, curvature = float(sums[0]), sums[1:1 + k], sums[1 + k:].reshape(k, k)
    still = abs(deviance - model.deviance) <= TOLERANCE * (abs(deviance) + 0.1)
    inverse = np.linalg.pinv(curvature, hermitian=True)
    if still:
        error = np.sqrt(np.maximum(np.diag(inverse), 0))
        z = np.divide(np.abs(model.beta), error, out=np.zeros(k), where=error > 0)
        model.p = np.array([math.erfc(v / math.sqrt(2)) for v in z])
        model.settled = True
    else:
        model.beta = model.beta + inverse @ gradient
    model.deviance = deviance


def fit_logits(rows: DataFrame, models: list[Logit], rounds: int = ROUNDS, pass_bytes: int = PASS_BYTES) -> int:
    """Fit all models in place; the number of passes over the rows."""
    passes = 0
    for turn in range(rounds):
        moving = {i: m for i, m in enumerate(models) if not m.settled}
        if not moving:
            break
        for wave in dealt(moving, lambda m: (len(m.beta) + 1) ** 2, pass_bytes):
            passes += 1
            for i, sums in sums_by_model(rows, {i: (m.columns, m.beta) for i, m in wave.items()}, newton_sums).items():
                if turn == rounds - 1:
                    models[i].deviance = float(sums[0])      # it ends where it stands
                _solved(models[i], sums)
    return passes


def _rows(df: DataFrame, y: str, features: list[str]) -> tuple[DataFrame, int, list[int]]:
    """One array column with the outcome and the standardised columns; the number of rows; the columns that vary."""
    value = lambda c: F.col(f"`{c}`").cast("double")
    clean = df.select(*[value(c).alias(f"v{k}") for k, c in enumerate([y, *features])]).na.drop()
    m = clean.agg(F.count(F.lit(1)), *[f(f"v{k + 1}") for k in range(len(features)) for f in (F.avg, F.stddev_pop)]).first()
    n, centre, spread = m[0], m[1::2], m[2::2]
    scaled = [(F.col(f"v{k + 1}") - F.lit(c)) / F.lit(s) if s else F.lit(0.0) for k, (c, s) in enumerate(zip(centre, spread))]
    return settle(clean.select(F.array(F.col("v0"), *scaled).alias("x"))), n, [k for k, s in enumerate(spread) if s]


def forward_select(df: DataFrame, y: str, features: list[str], level: float = LEVEL, pass_bytes: int = PASS_BYTES) -> list[str]:
    """Add the column with the smallest p value while it stays below the level."""
    rows, n, varying = _rows(df, y, features)
    chosen: list[int] = []
    beta = np.zeros(1)
    while n:
        models = [Logit([*chosen, k], np.concatenate([beta[:-1], [0.0], beta[-1:]])) for k in varying if k not in chosen]
        if not models:
            break
        fit_logits(rows, models, pass_bytes=pass_bytes)
        fitted = [m for m in models if m.settled]
        best = min(fitted, key=lambda m: m.p[len(chosen)], default=None)
        if best is None or not best.p[len(chosen)] < level:
            break
        chosen, beta = best.columns, best.beta
    return [features[k] for k in chosen]


def backward_eliminate(df: DataFrame, y: str, features: list[str], level: float = LEVEL) -> list[str]:
    """Remove the column with the largest p value while it is at or above the level; constant columns go first."""
    rows, n, left = _rows(df, y, features)
    beta = np.zeros(len(left) + 1)
    while n and left:
        model = Logit(list(left), beta)
        fit_logits(rows, [model])
        if not model.settled:
            break
        worst = int(np.argmax(model.p[:-1]))
        if model.p[worst] < level:
            break
        left, beta = [*left[:worst], *left[worst + 1:]], np.delete(model.beta, worst)
    return [features[k] for k in left]
