"""One-step and recursive forecasts from lagged values."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from brambling.operators import encode, models, series as S
from brambling.operators.series import Blocks


def lag_forecast(bars: DataFrame, test_start: str, lags: int = 60, b: Blocks = Blocks()) -> DataFrame:
    """Regress the scaled price on its lags (all series share the model) and predict the test range:
    ``predicted`` uses the true lags, ``forecast`` feeds its own predictions back.

    The recursion runs per series over the test horizon only, from the lags of its first row.
    """
    ranges = encode.fit_ranges(bars.filter(F.col(b.time) < F.lit(test_start).cast("timestamp_ntz")), ["price"])
    scaled = encode.scale(bars.select(*b.keys, b.time, "price"), ranges)
    held = S.rolling(S.positioned(scaled, b), b, lags, lambda w: {"lags": S.lag_values(F.col("price"), lags, w)})
    held = held.filter(F.col("lags").isNotNull())
    is_test = F.col(b.time) >= F.lit(test_start).cast("timestamp_ntz")
    train = models.assemble_array(held.filter(~is_test), "lags", ["price"])
    model = LinearRegression(labelCol="price", regParam=1e-6).fit(train)
    weights, bias = [float(w) for w in model.coefficients], float(model.intercept)
    test = held.filter(is_test)
    one = F.aggregate(F.zip_with("lags", F.lit(weights), lambda x, w: x * w), F.lit(bias), lambda s, x: s + x)
    first = test.groupBy(*b.keys).agg(F.min_by("lags", "pos").alias("first_lags"), F.min("pos").alias("_from"),
                                      F.max("pos").alias("_to"))
    types = {f.name: f.dataType.simpleString() for f in bars.schema.fields}

    def recurse(batches):
        w, names = np.array(weights), [*b.keys, "pos", "forecast"]
        for pdf in batches:
            rows = []
            for row in pdf.to_dict("records"):
                window = np.array(row["first_lags"], dtype=float)
                for pos in range(int(row["_from"]), int(row["_to"]) + 1):
                    value = float(window @ w + bias)
                    rows.append((*[row[k] for k in b.keys], pos, value))
                    window = np.append(window[1:], value)
                    if len(rows) >= 10_000:      # a long horizon leaves in pieces
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            yield pd.DataFrame(rows, columns=names)

    keys = ", ".join(f"`{k}` {types[k]}" for k in b.keys)
    ahead = first.mapInPandas(recurse, f"{keys}, pos bigint, forecast double")
    out = test.withColumn("predicted", one).join(ahead, [*b.keys, "pos"])
    low, high = ranges["price"]
    back = {c: F.col(c) * (high - low or 1.0) + low for c in ("price", "predicted", "forecast")}
    return out.withColumns(back).select(*b.keys, b.time, "price", "predicted", "forecast")
