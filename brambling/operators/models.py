"""Models: fit on a prepared frame, results as frames.  Loops cache the assembled vectors once."""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from brambling.operators import evaluate, forest, mixture, stepwise
from brambling.operators.encode import fit_medians, impute
from brambling.operators.explore import explained_variance
from brambling.session import settle


def assemble(df: DataFrame, features: list[str], keep: list[str] | None = None) -> DataFrame:
    """Feature columns as one vector; rows with a missing feature are left out."""
    keep = df.columns if keep is None else keep
    clean = df.na.drop(subset=features)
    return VectorAssembler(inputCols=features, outputCol="features").transform(clean).select(*keep, "features")


def assemble_array(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    return df.select(*keep, array_to_vector(F.col(column).cast("array<double>")).alias("features"))


@contextmanager
def cached(df: DataFrame):
    held = df.persist()
    try:
        yield held
    finally:
        held.unpersist()


def _table(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


# --- linear models -------------------------------------------------------------------------------

def ols(df: DataFrame, y: str, features: list[str]) -> DataFrame:
    """Least squares with a constant: estimate, standard error, t, p per term, and R2 of the fit."""
    with cached(assemble(df, features, [y])) as data:     # the summary reads the rows again
        model = LinearRegression(labelCol=y, solver="normal", regParam=0.0).fit(data)
        s = model.summary
        estimates = [*map(float, model.coefficients), float(model.intercept)]
        rows = [(name, e, float(se), float(t), float(p), float(s.r2)) for name, e, se, t, p in zip(
            [*features, "const"], estimates, s.coefficientStandardErrors, s.tValues, s.pValues)]
    return _table(df, rows, "term string, estimate double, std_error double, t double, p double, r2 double")


def linear_coefficients(df: DataFrame, y: str, features: list[str]) -> DataFrame:
    model = LinearRegression(labelCol=y, regParam=0.0, solver="normal").fit(assemble(df, features, [y]))
    return _table(df, [(f, float(c)) for f, c in zip(features, model.coefficients)], "feature string, coefficient double")


def _logit(data: DataFrame, y: str):
    return GeneralizedLinearRegression(family="binomial", link="logit", labelCol=y, maxIter=50).fit(data)


def logit_inference(df: DataFrame, y: str, features: list[str]) -> DataFrame:
    """Logistic coefficients with standard error, z and p."""
    with cached(assemble(df, features, [y])) as data:
        model = _logit(data, y)
        s = model.summary
        rows = [(n, float(e), float(se), float(z), float(p)) for n, e, se, z, p in zip(
            [*features, "const"], [*model.coefficients, model.intercept], s.coefficientStandardErrors, s.tValues, s.pValues)]
    return _table(df, rows, "term string, estimate double, std_error double, z double, p double")


def fit_logistic(df: DataFrame, y: str, features: list[str]):
    return LogisticRegression(labelCol=y, regParam=0.0, maxIter=200).fit(assemble(df, features, [y]))


def odds_table(df: DataFrame, model, features: list[str]) -> DataFrame:
    rows = [(f, float(c), math.exp(float(c))) for f, c in zip(features, model.coefficients)]
    return _table(df, sorted(rows, key=lambda r: (-r[2], r[0])), "feature string, coefficient double, odds_ratio double")


def forward_select(df: DataFrame, y: str, features: list[str], level: float = stepwise.LEVEL) -> list[str]:
    """Add the column with the smallest p value while it stays below the level."""
    return stepwise.forward_select(df, y, features, level)


def backward_eliminate(df: DataFrame, y: str, features: list[str], level: float = stepwise.LEVEL) -> list[str]:
    """Remove the column with the largest p value while it is at or above the level."""
    return stepwise.backward_eliminate(df, y, features, level)


# --- trees and other supervised models -----------------------------------------------------------

def tree_regressor(y: str, depth: int = 8, min_leaf: int = 30):
    return DecisionTreeRegressor(labelCol=y, maxDepth=depth, minInstancesPerNode=min_leaf, seed=42)


def forest_regressor(y: str, trees: int = 300, features: str = "12", depth: int = 8, min_leaf: int = 30):
    return RandomForestRegressor(labelCol=y, numTrees=trees, featureSubsetStrategy=features, maxDepth=depth,
                                 minInstancesPerNode=min_leaf, seed=42)


def gbt_regressor(y: str, rounds: int = 300, depth: int = 5):
    return GBTRegressor(labelCol=y, maxIter=rounds, maxDepth=depth, seed=42)


def tree_classifier(y: str, depth: int = 8, min_leaf: int = 30):
    return DecisionTreeClassifier(labelCol=y, maxDepth=depth, minInstancesPerNode=min_leaf, seed=42)


def forest_classifier(y: str, trees: int = 300, depth: int = 8, min_leaf: int = 30):
    return RandomForestClassifier(labelCol=y, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=42)


def gbt_classifier(y: str, rounds: int = 300, depth: int = 5, rate: float = 0.1):
    """Boosted trees; also stands in for the boosting library that is not part of Spark."""
    return GBTClassifier(labelCol=y, maxIter=rounds, maxDepth=depth, stepSize=rate, seed=42)


BINS = 32              # the trees' own number of bins
WHOLE = 10_000         # up to so many rows, bins are cut from all values, beyond from quantiles
POINTS, CELLS = 5_000, 20_000


def _cut(values: np.ndarray, counts: np.ndarray, bins: int) -> list[float]:
    """Edges between ascending values: all midpoints if they are few, else near equal shares of the rows."""
    if len(values) <= bins:
        return list((values[1:] + values[:-1]) / 2)
    stride = counts.sum() / bins
    edges, target, upto = [], stride, counts[0]
    for i in range(1, len(values)):
        before, upto = upto, upto + counts[i]
        if abs(before - target) < abs(upto - target):
            edges.append((values[i - 1] + values[i]) / 2)
            target += stride
    return edges


def bin_edges(df: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """The edges of each feature's bins; a value on an edge belongs to the bin below it."""
    sizes = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    numbers = [F.col(f).cast("double") for f in features]
    if sizes <= WHOLE:
        columns = list(zip(*df.select(*numbers).collect())) or [()] * len(features)
    else:
        columns = df.agg(*[F.percentile_approx(x, [i / POINTS for i in range(POINTS + 1)], 2 * POINTS) for x in numbers]).first()
    return [_cut(*np.unique(np.array([v for v in c if not math.isnan(v)] or [0.0], float), return_counts=True), bins) or [float(max(c, default=0.0))]
            for c in columns]


def fit_binned(estimator, train: DataFrame, y: str, features: list[str]) -> PipelineModel:
    """Boosted trees from counted bins: the model takes the raw feature columns, bins them and predicts.

    Trees see no more of a feature than its bin, so rows with the same bins (and class) always share a leaf, and one row
    with their number as weight (and the mean of a numeric label) gives the same splits and leaves.  The rounds then read
    these cells, of which there are at most ``bins`` to the power of the features, instead of the rows.
    """
    rows = train.na.drop(subset=features).select(y, *features)
    binned = [f"{f}__bin" for f in features]
    edges = [[-math.inf, *[math.nextafter(e, math.inf) for e in cuts], math.inf] for cuts in bin_edges(rows, features)]
    bucketizer = Bucketizer(inputCols=features, outputCols=binned, splitsArray=edges, handleInvalid="keep")
    placed = bucketizer.transform(rows)
    classes = isinstance(estimator, GBTClassifier)
    placed = placed.select(y, *[(F.col(b) + 0.0).alias(b) for b in binned])     # numbers in order, not names of buckets
    cells = (placed.groupBy(*([y] if classes else []), *binned)
             .agg(F.count(F.lit(1)).cast("double").alias("weight"), *([] if classes else [F.avg(y).alias(y)])))
    cells = settle(cells)
    tasks = min(max(math.ceil(cells.count() / CELLS), 1), cells.sparkSession.sparkContext.defaultParallelism)
    assembler = VectorAssembler(inputCols=binned, outputCol="features")
    with cached(assembler.transform(cells.repartition(tasks).sortWithinPartitions(*binned)).select(y, "weight", "features")) as data:
        model = estimator.copy({estimator.weightCol: "weight"}).fit(data)
    return PipelineModel(stages=[bucketizer, assembler, model])


def score_binned(model: PipelineModel, df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    return model.transform(df.na.drop(subset=features)).select(*keep, "prediction")


DRAWS = 5_000_000      # draws of a forest (rows times trees) that one task may make
GROWN = 20_000_000     # draws beyond which a forest is grown from packed bins


def fit_forest(estimator, data: DataFrame):
    """A forest's work is rows times trees; small rows, however, come in one piece after a join, so they are dealt out
    by that product and not by their bytes; beyond ``GROWN`` they are packed as bins (``forest``)."""
    data = settle(data)
    rows = data.count()
    if rows * estimator.getNumTrees() > GROWN and forest.suits(estimator):
        return forest.grow(estimator, data, rows, bin_edges)
    tasks = math.ceil(rows * estimator.getNumTrees() / DRAWS)
    if tasks <= 1:
        return estimator.fit(data)
    cores = data.sparkSession.sparkContext.defaultParallelism
    with cached(data.repartition(math.ceil(tasks / cores) * cores)) as dealt:
        return estimator.fit(dealt)


def gaussian_nb(y: str):
    return NaiveBayes(labelCol=y, modelType="gaussian")


def saved(model, path: str):
    """The model as it is read back from where it was written."""
    model.write().overwrite().save(path)
    return type(model).load(path)


def fit_score(estimator, train: DataFrame, test: DataFrame, y: str, features: list[str], keys: list[str]) -> tuple:
    """The model and the scored test rows (``prediction``)."""
    if isinstance(estimator, (GBTClassifier, GBTRegressor)):
        model = fit_binned(estimator, train, y, features)
        return model, score_binned(model, test, features, [*keys, y])
    if isinstance(estimator, (RandomForestClassifier, RandomForestRegressor)):
        model = fit_forest(estimator, assemble(train, features, [y]))
    else:
        model = estimator.fit(assemble(train, features, [y]))
    return model, model.transform(assemble(test, features, [*keys, y])).select(*keys, y, "prediction")


def predict_proba(model, df: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """Predicted class and probability of class 1."""
    scored = model.transform(assemble(df, features, keys))
    return scored.select(*keys, F.col("prediction").cast("int").alias("predicted"),
                         vector_to_array("probability")[1].alias("probability"))


def feature_importance(df: DataFrame, model, features: list[str]) -> DataFrame:
    weights = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    rows = sorted(((f, abs(float(weights[i]))) for i, f in enumerate(features)), key=lambda r: (r[1], r[0]))
    return _table(df, rows, "feature string, importance double")


def cross_validate(df: DataFrame, y: str, features: list[str], fold: str, k: int, estimator=None) -> DataFrame:
    """R2 and root mean squared error per fold; the fold column says which rows are held out."""
    estimator = estimator or LinearRegression(labelCol=y, regParam=0.0, solver="normal")
    rows = []
    with cached(assemble(df, features, [y, fold])) as data:
        for i in range(k):
            model = estimator.fit(data.filter(F.col(fold) != i))
            m = evaluate.regression_metrics(model.transform(data.filter(F.col(fold) == i)), y, "prediction").first()
            rows.append((i, m["r2"], m["rmse"]))
    return _table(df, rows, "fold int, r2 double, rmse double")


def fold_means(scores: DataFrame) -> DataFrame:
    """Mean R2 and mean root mean squared error over the folds."""
    return scores.agg(F.avg("r2").alias("mean_r2"), F.avg("rmse").alias("mean_rmse"))


def iterative_impute(df: DataFrame, columns: list[str], rounds: int = 3) -> DataFrame:
    """Fill each column from a regression on the others, least missing first, for a few rounds."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
    order = sorted((c for c in columns if counts[c]), key=lambda c: (counts[c], c))
    filled = impute(df.withColumns({f"_gap_{c}": F.col(c).isNull() for c in order}), fit_medians(df, order))
    for _ in range(rounds):
        for c in order:
            others = [o for o in columns if o != c]
            model = LinearRegression(labelCol=c, solver="normal", regParam=0.0).fit(
                assemble(filled.filter(~F.col(f"_gap_{c}")), others, [c]))
            guess = sum((F.col(o) * float(w) for o, w in zip(others, model.coefficients)), F.lit(float(model.intercept)))
            filled = filled.withColumn(c, F.when(F.col(f"_gap_{c}"), guess).otherwise(F.col(c)))
        filled = settle(filled)     # a round's fits read the rows of the round before, not its whole plan
    return filled.drop(*[f"_gap_{c}" for c in order])


# --- clusters and components ----------------------------------------------------------------------

def kmeans(vectors: DataFrame, k: int, seed: int = 42):
    return KMeans(k=k, seed=seed, maxIter=50).fit(vectors)


def total_spread(vectors: DataFrame) -> DataFrame:
    """Within-cluster sum of squares of a single cluster: n times the summed population variances."""
    arrays = vectors.select(F.posexplode(vector_to_array("features")).alias("d", "x"))
    return arrays.groupBy("d").agg((F.var_pop("x") * F.count("x")).alias("s")).agg(F.sum("s").alias("cost"))


def elbow(vectors: DataFrame, ks: list[int], seed: int = 42) -> DataFrame:
    """Within-cluster sum of squares for each k; k = 1 by its closed form."""
    rows = []
    with cached(vectors) as data:
        for k in ks:
            cost = total_spread(data).first()["cost"] if k == 1 else kmeans(data, k, seed).summary.trainingCost
            rows.append((k, float(cost)))
    return _table(vectors, rows, "k int, cost double")


def gaussian_mixtures(vectors: DataFrame, ks: list[int], starts: int = mixture.STARTS, rounds: int = mixture.ROUNDS) -> DataFrame:
    """Best log-likelihood of several starts per k, with AIC and BIC (full covariances)."""
    return mixture.curves(vectors, ks, starts, rounds)


def _second_moments(vectors: DataFrame):
    """Row count, mean and population covariance, computed on the executors; only d x d numbers arrive."""
    row = vectors.select(Summarizer.metrics("count", "mean", "variance").summary(F.col("features")).alias("s")).first()["s"]
    n, mean = row["count"], row["mean"].toArray()
    spread = np.sqrt(row["variance"].toArray())
    corr = np.nan_to_num(Correlation.corr(vectors, "features").first()[0].toArray())
    np.fill_diagonal(corr, 1.0)
    return n, mean, corr * np.outer(spread, spread) * (n - 1) / n


def hierarchical(vectors: DataFrame, k: int, seed: int = 42):
    """Top-down splitting; stands in for complete linkage, which needs all pairwise distances."""
    return BisectingKMeans(k=k, seed=seed).fit(vectors)


def centred(vectors: DataFrame) -> DataFrame:
    """Vectors minus their mean (one row, joined to all)."""
    mean = vectors.select(vector_to_array(Summarizer.mean(F.col("features"))).alias("_mean"))
    less = F.zip_with(vector_to_array("features"), F.col("_mean"), lambda a, b: a - b)
    return vectors.join(F.broadcast(mean)).withColumn("features", array_to_vector(less)).drop("_mean")


def principal_components(vectors: DataFrame, k: int | None = None, share: float | None = None):
    """PCA with centred scores; ``share`` picks the number of components that explains so much variance."""
    d = len(vectors.first()["features"])
    model = PCA(k=d if k is None else k, inputCol="features", outputCol="scores").fit(vectors)
    ratios, axes = [float(v) for v in model.explainedVariance], model.pc.toArray()
    if share is not None:
        reached = explained_variance(ratios, share)[1]
        ratios, axes = ratios[:reached], axes[:, :reached]
    return centred(vectors).withColumn("scores", _project(axes)).drop("features"), ratios


def _project(axes: np.ndarray) -> Column:
    """Products of the row's vector with the columns of a d x k matrix."""
    rows = [[float(x) for x in axes[:, j]] for j in range(axes.shape[1])]
    dot = lambda w: F.aggregate(F.zip_with(vector_to_array("features"), w, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return F.transform(F.lit(rows), dot)


def singular_values(vectors: DataFrame, k: int) -> tuple[list[float], DataFrame]:
    """Leading singular values and the low-rank scores U * S = X * V, from the d x d cross products."""
    n, mean, cov = _second_moments(vectors)
    values, axes = np.linalg.eigh(n * (cov + np.outer(mean, mean)))
    lead = np.argsort(values)[::-1][:k]
    scores = vectors.withColumn("scores", _project(axes[:, lead])).drop("features")
    return [float(np.sqrt(max(values[i], 0.0))) for i in lead], scores
