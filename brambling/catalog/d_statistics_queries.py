"""Exploration statistics and model evaluation."""

from pyspark.sql import functions as F

from brambling.catalog.inputs import CLUSTERED, HOUSE, LOANS, SCORED, clustered, house, loans, scored
from brambling.catalog.registry import query
from brambling.functions import columns as C
from brambling.operators import aggregate as A, evaluate as E, explore as X


def r(df, *names, digits=4):
    return df.withColumns({n: F.round(n, digits) + 0.0 for n in names})


def each(columns, body):
    """The statement once per column, glued together; ``{c}`` is the column."""
    return " union all ".join(body.replace("{c}", c) for c in columns)


COLS = ["price", "quantity", "retail"]


@query("st1_st2_shape_moments", f"with {HOUSE} " + each(COLS, """select '{c}' as "column", round(skewness({c}), 4) + 0.0::double as skewness, round(kurtosis({c}), 4) + 0.0::double as kurtosis from house"""))
def _(t):
    return r(X.shape_moments(house(t), COLS), "skewness", "kurtosis")


@query("st3_histogram", f"with {HOUSE}, r as (" + each(COLS, "select '{c}' as \"column\", min({c}) as lo, max({c}) as hi from house") + "), v as (" +
       each(COLS, "select '{c}' as \"column\", {c} as v from house") + """), b as (select "column", least(29, floor((v - lo) / ((hi - lo) / 30)))::bigint as bin, lo, hi from v join r using ("column"))
  select "column", bin, round(lo + bin * ((hi - lo) / 30), 4) + 0.0::double as "left", count(*) as n from b group by all""")
def _(t):
    return r(X.histogram(house(t), COLS), "left")


@query("st4_boxplot_stats", f"with {HOUSE}, v as (" + each(COLS, "select '{c}' as \"column\", {c} as v from house") + """), q as (select "column", quantile_cont(v, .25) as q1, quantile_cont(v, .5) as median, quantile_cont(v, .75) as q3 from v group by 1)
  select "column", q1, median, q3, min(v) filter (v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as low_whisker, max(v) filter (v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as high_whisker,
  count(*) filter (not (v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))) as outliers from v join q using ("column") group by all""")
def _(t):
    return X.boxplot_stats(house(t), COLS)


@query("st5_normal_bounds", f"with {LOANS}, v as (" + each(["amount", "balance"], "select '{c}' as \"column\", {c} as v from loans") + """), q as (select "column", avg(v) - 3 * stddev_samp(v) as lower, avg(v) + 3 * stddev_samp(v) as upper, count(*) as n from v group by 1)
  select "column", round(lower, 4) as lower, round(upper, 4) as upper, count(*) filter (v > upper) as above, count(*) filter (v < lower) as below,
  round(count(*) filter (v > upper) / n, 6) as above_share, round(count(*) filter (v < lower) / n, 6) as below_share from v join q using ("column") group by "column", lower, upper, n""")
def _(t):
    return r(r(X.normal_bounds(loans(t), ["amount", "balance"]), "lower", "upper"), "above_share", "below_share", digits=6)


@query("st6_iqr_bounds", f"with {LOANS}, v as (" + each(["amount", "balance"], "select '{c}' as \"column\", {c} as v from loans") + """), i as (select "column", quantile_cont(v, .25) as q1, quantile_cont(v, .75) as q3, count(*) as n from v group by 1), q as (select "column", q1 - (q3 - q1) * 0.5 as lower, q3 + (q3 - q1) * 0.5 as upper, n from i)
  select "column", round(lower, 4) as lower, round(upper, 4) as upper, count(*) filter (v > upper) as above, count(*) filter (v < lower) as below,
  round(count(*) filter (v > upper) / n, 6) as above_share, round(count(*) filter (v < lower) / n, 6) as below_share from v join q using ("column") group by "column", lower, upper, n""")
def _(t):
    return r(r(X.iqr_bounds(loans(t), ["amount", "balance"], 0.5), "lower", "upper"), "above_share", "below_share", digits=6)


@query("ag15_outlier_counts", f"""with {HOUSE}, q as (select avg(price) - 1.5 * stddev_samp(price) as lo, avg(price) + 1.5 * stddev_samp(price) as hi from house)
  select count(*) as total, count(*) filter (price > hi) as "right", count(*) filter (price < lo) as "left", round(100.0::double * count(*) filter (price > hi) / count(*), 6) as right_percent,
  round(100.0::double * count(*) filter (price < lo) / count(*), 6) as left_percent from house, q""")
def _(t):
    h = house(t)
    q = h.agg((F.avg("price") - 1.5 * F.stddev_samp("price")).alias("lo"), (F.avg("price") + 1.5 * F.stddev_samp("price")).alias("hi"))
    out = h.select("price").join(F.broadcast(q)).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("price") > F.col("hi")).alias("right"), F.count_if(F.col("price") < F.col("lo")).alias("left"))
    return out.withColumns({"right_percent": F.round(F.col("right") * 100.0 / F.col("total"), 6), "left_percent": F.round(F.col("left") * 100.0 / F.col("total"), 6)})


@query("st7_corr_matrix", f"""with {LOANS} select 'amount' as a, 'balance' as b, round(corr(amount, balance), 6) + 0.0::double as r from loans
  union all select 'amount', 'nation', round(corr(amount, nation), 6) + 0.0::double from loans union all select 'balance', 'nation', round(corr(balance, nation), 6) + 0.0::double from loans""")
def _(t):
    return r(X.corr_matrix(loans(t), ["amount", "balance", "nation"]), "r", digits=6)


@query("st8_target_corr", f"""with {HOUSE} select 'quantity' as "column", round(corr(price, quantity), 6) + 0.0::double as r from house
  union all select 'size', round(corr(price, size), 6) + 0.0::double from house union all select 'retail', round(corr(price, retail), 6) + 0.0::double from house""")
def _(t):
    return r(X.target_corr(house(t), "price", ["quantity", "size", "retail"]), "r", digits=6)


def normal_quantile_sql(p):
    """The published approximation once more, written out for DuckDB."""
    tail = f"sqrt(-2 * ln(least({p}, 1 - {p})))"
    outer = (f"(((((-0.007784894002430293 * {tail} - 0.3223964580411365) * {tail} - 2.400758277161838) * {tail} - 2.549732539343734) * {tail} + 4.374664141464968) * {tail} + 2.938163982698783)"
             f" / ((((0.007784695709041462 * {tail} + 0.3224671290700398) * {tail} + 2.445134137142996) * {tail} + 3.754408661907416) * {tail} + 1)")
    q = f"({p} - 0.5)"
    s = f"({q} * {q})"
    middle = (f"(((((-39.69683028665376 * {s} + 220.9460984245205) * {s} - 275.9285104469687) * {s} + 138.3577518672690) * {s} - 30.66479806614716) * {s} + 2.506628277459239) * {q}"
              f" / (((((-54.47609879822406 * {s} + 161.5858368580409) * {s} - 155.6989798598866) * {s} + 66.80131188771972) * {s} - 13.28068155288572) * {s} + 1)")
    return f"case when {p} < 0.02425 then {outer} when {p} > 1 - 0.02425 then -({outer}) else {middle} end::double"


@query("st9_qq_points", f"""with k as (select o_orderkey, o_totalprice as value, ((row_number() over (order by o_totalprice, o_orderkey) - 0.5::double) / count(*) over ())::double as p from orders)
  select o_orderkey, value, round({normal_quantile_sql('p')}, 6) + 0.0::double as theoretical from k""")
def _(t):
    return r(X.qq_points(t.orders, "o_totalprice", "o_orderkey"), "theoretical", digits=6)


@query("st10_grid_points", f"""with {HOUSE} select floor(size / 5.0::double)::bigint as gx, floor(retail / 100.0::double)::bigint as gy, count(*) as n, round(avg(price), 4) as weight from house where price < 80000 group by all""")
def _(t):
    return r(X.grid_points(house(t), "size", "retail", "price", 5.0, 100.0, below=80000), "weight")


@query("st11_vif", f"""with {HOUSE}, g as (select sum(quantity * quantity) as aa, sum(quantity * retail) as ab, sum(retail * retail) as bb from house)
  select 'quantity' as "column", round(aa * bb / (aa * bb - ab * ab), 4) as vif from g union all select 'retail', round(aa * bb / (aa * bb - ab * ab), 4) from g""")
def _(t):
    return r(X.vif(house(t), ["quantity", "retail"]), "vif")


@query("st12_residuals", f"""with {HOUSE}, f as (select regr_slope(price, quantity) as a, regr_intercept(price, quantity) as b from house)
  select sale_id, line, price, quantity, round(price - (a * quantity + b), 3) + 0.0::double as residual from house, f""")
def _(t):
    h = house(t).select("sale_id", "line", "price", "quantity")
    fit = h.agg(F.regr_slope("price", "quantity").alias("a"), F.regr_intercept("price", "quantity").alias("b"))
    scored_ = h.join(F.broadcast(fit)).withColumn("yhat", F.col("a") * F.col("quantity") + F.col("b"))
    return r(X.residuals(scored_, "price", "yhat").select("sale_id", "line", "price", "quantity", "residual"), "residual", digits=3)


@query("st13_density", """with r as (select min(o_totalprice) as lo, max(o_totalprice) as hi, (max(o_totalprice) - min(o_totalprice)) / 1024 as step from orders),
  s as (select o_orderstatus, count(*) as n, stddev_samp(o_totalprice) * pow(count(*), -0.2) as h from orders group by 1),
  b as (select o_orderstatus, least(1023, floor((o_totalprice - lo) / step)) as bin, count(*) as c from orders, r group by all),
  g as (select lo + i * ((hi - lo) / 63) as x from r, range(64) k(i))
  select o_orderstatus, round(x, 4) as x, round(1e6 * sum(c * exp(-pow((x - (lo + (bin + 0.5) * step)) / h, 2) / 2) / (h * sqrt(2 * pi()) * n)), 6) as density from b join s using (o_orderstatus), r, g group by all""")
def _(t):
    out = X.density(t.orders, "o_orderstatus", "o_totalprice")
    return out.select("o_orderstatus", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density"))


@query("st14_class_counts", f"with {LOANS} select segment, loan_status, count(*) as n from loans group by all")
def _(t):
    return A.group_count(loans(t), ["segment", "loan_status"])


# --- evaluation --------------------------------------------------------------------------------

@query("ev1_regression_metrics", f"""with {HOUSE}, f as (select regr_slope(price, quantity) as a, regr_intercept(price, quantity) as b, avg(price) as m from house), e as (select price - (a * quantity + b) as e, price - m as d from house, f)
  select round(1 - sum(e * e) / sum(d * d), 4) as r2, round(avg(e * e), 4) as mse, round(sqrt(avg(e * e)), 4) as rmse from e""")
def _(t):
    h = house(t).select("price", "quantity")
    fit = h.agg(F.regr_slope("price", "quantity").alias("a"), F.regr_intercept("price", "quantity").alias("b"))
    return E.regression_metrics(h.join(F.broadcast(fit)).withColumn("yhat", F.col("a") * F.col("quantity") + F.col("b")), "price", "yhat")


def called(t, threshold=0.5):
    return scored(t).withColumn("yhat", C.threshold_predict(F.col("p"), threshold))


CALLED = f"{SCORED}, called as (select *, case when p > 0.5 then 1 else 0 end as yhat from scored)"


@query("ev3_confusion_matrix", f"""with {CALLED}, g as (select a.v as actual, b.v as predicted from (values (0), (1)) a(v), (values (0), (1)) b(v))
  select actual, predicted, count(y) as n from g left join called on y = actual and yhat = predicted group by all""")
def _(t):
    return E.confusion_matrix(called(t), "y", "yhat", [0, 1])


@query("ev4_classification_report", f"""with {CALLED}, c as (select k as label, count(*) filter (y = k and yhat = k) as tp, count(*) filter (y = k) as support, count(*) filter (yhat = k) as called from called, (values (0), (1)) l(k) group by k),
  p as (select *, coalesce(tp / nullif(called, 0), 0.0::double) as precision, coalesce(tp / nullif(support, 0), 0.0::double) as recall from c),
  f as (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0::double) as f1 from p)
  select label::varchar as label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from f
  union all select 'accuracy', null, null, round(sum(tp) / sum(support), 6), sum(support)::bigint from f
  union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::bigint from f
  union all select 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::bigint from f""")
def _(t):
    return r(E.classification_report(called(t), "y", "yhat", [0, 1]), "precision", "recall", "f1", digits=6)


@query("ev5_roc_auc", f"""with {SCORED} select round(sum(case when a.p > b.p then 1.0 when a.p = b.p then 0.5 else 0.0 end)::double / count(*), 6) as auc
  from scored a, scored b where a.y = 1 and b.y = 0""")
def _(t):
    return r(E.roc_auc(scored(t), "y", "p"), "auc", digits=6)


STEPS = f"""{SCORED}, n as (select count(*) filter (y = 1) as pos, count(*) filter (y = 0) as neg from scored),
  k as (select p as threshold, sum(y) as p1, sum(1 - y) as n1 from scored group by p),
  s as (select threshold, p1, sum(p1) over (order by threshold desc) as tp, sum(n1) over (order by threshold desc) as fp, pos, neg from k, n)"""


@query("ev6_roc_curve", f"with {STEPS} select threshold, round(fp / neg, 6)::double as fpr, round(tp / pos, 6)::double as tpr from s")
def _(t):
    return r(E.roc_curve(scored(t), "y", "p"), "fpr", "tpr", digits=6)


@query("ev7_pr_curve", f"with {STEPS} select threshold, round(tp / (tp + fp), 6)::double as precision, round(tp / pos, 6)::double as recall from s")
def _(t):
    return r(E.pr_curve(scored(t), "y", "p"), "precision", "recall", digits=6)


@query("ev7_average_precision", f"""with {STEPS}, c as (select tp / (tp + fp) as pr, tp / pos - coalesce(lag(tp / pos) over (order by threshold desc), 0) as gain from s)
  select round(sum(pr * gain), 6)::double as average_precision from c""")
def _(t):
    return r(E.average_precision(scored(t), "y", "p"), "average_precision", digits=6)


@query("ev8_threshold_sweep", f"""with {SCORED}, th as (select k / 100.0::double as threshold from range(100) r(k)),
  c as (select threshold, count(*) filter (y = 1 and p > threshold) as tp, count(*) filter (y = 0 and p > threshold) as fp, count(*) filter (y = 0 and not p > threshold) as tn, count(*) filter (y = 1 and not p > threshold) as fn from th, scored group by threshold)
  select threshold, round(coalesce(tn / nullif(tn + fn, 0), 0), 6) as precision_0, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision_1,
  round(coalesce(tn / nullif(tn + fp, 0), 0), 6) as recall_0, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall_1 from c""")
def _(t):
    return r(E.threshold_sweep(scored(t), "y", "p"), "precision_0", "precision_1", "recall_0", "recall_1", digits=6)


@query("ev9_select_threshold", f"with {STEPS} select threshold, round(tp / (tp + fp), 6)::double as precision, round(tp / pos, 6)::double as recall from s")
def _(t):
    return r(E.select_threshold(scored(t), "y", "p"), "precision", "recall", digits=6)


@query("ev10_accuracy", f"with {CALLED} select round(avg((y = yhat)::int), 6) as accuracy from called")
def _(t):
    return r(E.accuracy(called(t), "y", "yhat"), "accuracy", digits=6)


@query("ev11_prediction_table", f"with {CALLED} select doc_id, y as outcome, yhat as predicted, p as probability from called")
def _(t):
    return E.prediction_table(scored(t), "y", C.threshold_predict(F.col("p"), 0.5), "p", ["doc_id"])


@query("ev12_compare_clusters", f"""with {CLUSTERED}, c as (select label, cluster, count(*) as n from clustered group by all),
  m as (select label, arg_min(cluster, (-n, cluster)) as cluster from c group by label), o as (select cluster, max(label) as mapped from m group by cluster),
  j as (select label as actual, coalesce(mapped, -1) as predicted from clustered left join o using (cluster)),
  g as (select a.range::int as actual, b.range::int as predicted from range(-1, 10) a, range(-1, 10) b)
  select g.actual, g.predicted, count(j.actual) as n from g left join j using (actual, predicted) group by all""")
def _(t):
    c = clustered(t)
    owner = A.mode_per_class(c, "label", "cluster").select("cluster", F.col("mapped_label").alias("mapped")).distinct()
    named = c.join(owner, "cluster", "left").withColumn("mapped", F.coalesce("mapped", F.lit(-1)))
    return E.confusion_matrix(named, "label", "mapped", list(range(-1, 10)))
