"""Model evaluation as aggregates over a scored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brambling.operators.ordering import running_sums


def regression_metrics(df: DataFrame, y: str, predicted: str) -> DataFrame:
    """R2, mean squared error and its root, rounded to four places."""
    v, e = F.col(y), F.col(y) - F.col(predicted)
    # centred on the mean: var_pop is the stable form of the total sum of squares per row
    sums = df.agg(F.avg(e * e).alias("m"), F.var_pop(v).alias("t"))
    return sums.select(F.round(1 - F.try_divide("m", "t"), 4).alias("r2"), F.round("m", 4).alias("mse"),
                       F.round(F.sqrt("m"), 4).alias("rmse"))


def confusion_matrix(df: DataFrame, y: str, predicted: str, classes: list) -> DataFrame:
    """Counts over the full grid of classes, zeros included."""
    cells = [(a, p) for a in classes for p in classes]
    row = df.agg(*[F.count_if((F.col(y) == a) & (F.col(predicted) == p)).alias(f"c{i}") for i, (a, p) in enumerate(cells)])
    items = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{i}").alias("n"))
                      for i, (a, p) in enumerate(cells)])
    return row.select(F.explode(items).alias("cell")).select("cell.*")


def classification_report(df: DataFrame, y: str, predicted: str, classes: list) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted means; 0 where undefined."""
    conf = confusion_matrix(df, y, predicted, classes)
    hit = F.col("actual") == F.col("predicted")
    per = F.explode(F.array(*[F.lit(c) for c in classes]))
    sums = (conf.withColumn("label", per).groupBy("label")
            .agg(F.sum(F.when(hit & (F.col("actual") == F.col("label")), F.col("n")).otherwise(0)).alias("tp"),
                 F.sum(F.when(F.col("actual") == F.col("label"), F.col("n")).otherwise(0)).alias("support"),
                 F.sum(F.when(F.col("predicted") == F.col("label"), F.col("n")).otherwise(0)).alias("called"),
                 F.sum("n").alias("total")))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    rates = sums.withColumns({"precision": zero(F.try_divide("tp", "called")), "recall": zero(F.try_divide("tp", "support"))})
    rates = rates.withColumn("f1", zero(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))))
    names = ["precision", "recall", "f1"]
    lines = rates.select(F.col("label").cast("string").alias("label"), *names, F.col("support").cast("bigint").alias("support"))
    total = F.sum("support").cast("bigint").alias("support")
    macro = rates.agg(*[F.avg(n).alias(n) for n in names], total).select(F.lit("macro avg").alias("label"), *names, "support")
    weighted = (rates.agg(*[(F.sum(F.col(n) * F.col("support")) / F.sum("support")).alias(n) for n in names], total)
                .select(F.lit("weighted avg").alias("label"), *names, "support"))
    accuracy = (rates.agg((F.sum("tp") / F.sum("support")).alias("f1"), total)
                .select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                        F.lit(None).cast("double").alias("recall"), "f1", "support"))
    return lines.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def score_steps(df: DataFrame, y: str, score: str) -> DataFrame:
    """One row per distinct score with the positives and negatives at or above it.

    Rows are counted per score before anything is ordered, so ties and hot scores cost nothing.
    """
    counted = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).alias("_p"), F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).alias("_n"))
    steps = running_sums(counted, [F.desc("threshold")], {"tp": F.col("_p"), "fp": F.col("_n")})
    totals = df.agg(F.count_if(F.col(y) == 1).alias("positives"), F.count_if(F.col(y) != 1).alias("negatives"))
    return steps.join(F.broadcast(totals))


def roc_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    s = score_steps(df, y, score)
    return s.select("threshold", F.try_divide("fp", "negatives").alias("fpr"), F.try_divide("tp", "positives").alias("tpr"))


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Exact area: positives above each negative, ties counted half."""
    s = score_steps(df, y, score)
    above = F.col("tp") - F.col("_p")
    return s.groupBy("positives", "negatives").agg(F.sum(F.col("_n") * (above + F.col("_p") / 2)).alias("won")).select(
        F.try_divide(F.col("won"), F.col("positives").cast("double") * F.col("negatives")).alias("auc"))


def pr_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    s = score_steps(df, y, score)
    return s.select("threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    F.try_divide("tp", "positives").alias("recall"))


def average_precision(df: DataFrame, y: str, score: str) -> DataFrame:
    """Sum over scores of the gain in recall times the precision there; the gain of a step is its own positives."""
    s = score_steps(df, y, score)
    gain = F.try_divide(F.col("_p"), F.col("positives")) * F.col("tp") / (F.col("tp") + F.col("fp"))
    return s.agg(F.sum(gain).alias("average_precision"))


def threshold_sweep(df: DataFrame, y: str, score: str, steps: int = 100) -> DataFrame:
    """Precision and recall of both classes for ``score > t`` at t = 0, 1/steps, ...

    A row is above every threshold below its score, so rows are counted per threshold bucket
    (at most steps + 1 of them) and added up from the top; rows are never multiplied.
    """
    s = F.col(score)
    floor = F.floor(s * steps)
    # thresholds are k / steps as doubles: settle the border by comparing with the very value
    near = F.when(F.lit(1.0) * (floor + 1) / steps < s, floor + 1).when(F.lit(1.0) * floor / steps < s, floor).otherwise(floor - 1)
    top = F.greatest(F.lit(-1), F.least(F.lit(steps - 1), near)).cast("int")   # largest k with k/steps < score
    counted = df.groupBy(top.alias("k")).agg(F.count_if(F.col(y) == 1).alias("p"), F.count_if(F.col(y) == 0).alias("n"))
    cells = F.array_sort(F.collect_list(F.struct("k", "p", "n")))
    sums = counted.agg(cells.alias("cells"), F.sum("p").alias("P"), F.sum("n").alias("N"))
    add = lambda field: F.aggregate(F.filter("cells", lambda c: c["k"] >= F.col("k")), F.lit(0).cast("bigint"), lambda a, c: a + c[field])
    out = sums.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))).withColumns({"tp": add("p"), "fp": add("n")})
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tn, fn = F.col("N") - F.col("fp"), F.col("P") - F.col("tp")
    return out.select((F.col("k") / steps).alias("threshold"),
                      zero(tn, tn + fn).alias("precision_0"), zero(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision_1"),
                      zero(tn, F.col("N")).alias("recall_0"), zero(F.col("tp"), F.col("P")).alias("recall_1"))


def select_threshold(df: DataFrame, y: str, score: str) -> DataFrame:
    """Precision and recall against the threshold, for choosing one."""
    return pr_curve(df, y, score).select("threshold", "precision", "recall")


def accuracy(df: DataFrame, y: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(predicted)).cast("double")).alias("accuracy"))


def prediction_table(df: DataFrame, y: str, predicted: Column, score: str, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.col(y).alias("outcome"), predicted.alias("predicted"), F.col(score).alias("probability"))
