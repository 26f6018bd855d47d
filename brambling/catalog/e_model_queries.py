"""Feature preparation and models."""

from pyspark.sql import functions as F

from brambling.catalog.inputs import (CLUSTERED, DAILY, HOUSE, LOANS, STATUS, STATUS_SQL, TRANSACTIONS, bars, clustered, house,
                                      is_test, is_test_sql, loans, transactions)
from brambling.catalog.registry import query
from brambling.functions import columns as C
from brambling.operators import encode, evaluate as E, explore as X, models as M, split
from brambling.operators.aggregate import mode_per_class
from brambling.operators.ordering import quantiles_wide
from brambling.plans import forecast, prepare, recipes
from brambling.session import new_path

NUM = ["quantity", "size", "retail"]


def r(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) + 0.0 for n in names})


def halves(df, key):
    return df.filter(~is_test(key)), df.filter(is_test(key))


@query("fe1_ordinal_encode", f"""with {HOUSE}, m as (select brand, avg(price) as m from house where not {is_test_sql('sale_id')} group by brand),
  fit as (select brand, row_number() over (order by m, brand) - 1 as code from m) select sale_id, line, brand, code from house left join fit using (brand) where {is_test_sql('sale_id')}""")
def _(t):
    train, test = halves(house(t), "sale_id")
    return encode.apply_lookup(test.select("sale_id", "line", "brand"), encode.fit_ordinal(train, "brand", "price"), "brand")


@query("fe2_median_impute", f"""with {LOANS}, f as (select median(amount) as a, median(balance) as b from loans where not {is_test_sql('loan_id')})
  select loan_id, round(coalesce(amount, a), 4) as amount, round(coalesce(balance, b), 4) as balance from loans, f where {is_test_sql('loan_id')}""")
def _(t):
    train, test = halves(loans(t).select("loan_id", "amount", "balance"), "loan_id")
    return r(encode.impute(test, encode.fit_medians(train, ["amount", "balance"])), "amount", "balance", digits=4)


@query("fe3_iterative_impute")
def _(t):
    df = loans(t).select("loan_id", "amount", "balance", F.col("nation").cast("double").alias("nation"))
    return M.iterative_impute(df, ["amount", "balance", "nation"])


SCALED = f"""{HOUSE}, f as (select min(price) as lo, max(price) as hi, min(retail) as rlo, max(retail) as rhi from house where not {is_test_sql('sale_id')})"""


@query("fe4_minmax_scale", f"""with {SCALED} select sale_id, line, round((price - lo) / (hi - lo), 6) + 0.0::double as price, round((retail - rlo) / (rhi - rlo), 6) + 0.0::double as retail, 0.0::double as flat
  from house, f where {is_test_sql('sale_id')}""")
def _(t):
    train, test = halves(house(t).select("sale_id", "line", "price", "retail", F.lit(3.0).alias("flat")), "sale_id")
    return r(encode.scale(test, encode.fit_ranges(train, ["price", "retail", "flat"])), "price", "retail", "flat")


@query("fe5_inverse_scale", f"with {HOUSE} select sale_id, line, round(price, 2) as price from house")
def _(t):
    h = house(t).select("sale_id", "line", "price")
    ranges = encode.fit_ranges(h, ["price"])
    return r(encode.unscale(encode.scale(h, ranges), ranges), "price", digits=2)


@query("fe6_dummies", f"""with {LOANS} select loan_id, (segment = 'BUILDING')::int as "segment_BUILDING", (segment = 'FURNITURE')::int as "segment_FURNITURE",
  (segment = 'HOUSEHOLD')::int as "segment_HOUSEHOLD", (segment = 'MACHINERY')::int as "segment_MACHINERY" from loans where {is_test_sql('loan_id')}""")
def _(t):
    train, test = halves(loans(t), "loan_id")
    return encode.dummies(test, encode.fit_categories(train, ["segment"])[0], ["loan_id"])


@query("fe6_sparse_dummies", f"""with {LOANS}, v as (select distinct 0 as k, segment as value from loans where not {is_test_sql('loan_id')} union select distinct 1, nation::varchar from loans where not {is_test_sql('loan_id')} and nation is not null),
  later as (select k, value from (select *, row_number() over (partition by k order by value) as nth from v where value is not null) where nth > 1), p as (select k, value, row_number() over (order by k, value) - 1 as position from later)
  select loan_id, array_to_string(list_sort(list_filter([a.position, b.position], lambda x: x is not null)), ',') as hot
  from loans left join p a on a.k = 0 and a.value = segment left join p b on b.k = 1 and b.value = nation::varchar where {is_test_sql('loan_id')}""")
def _(t):
    train, test = halves(loans(t), "loan_id")
    hot = encode.sparse_dummies(test.select("loan_id", "segment", "nation"), encode.fit_positions(train, ["segment", "nation"]))
    return hot.select("loan_id", F.array_join(F.transform("hot", lambda x: x.cast("string")), ",").alias("hot"))


def prepared_sql(source, numbers):
    return ", ".join(f"round(({c} - lo_{c}) / nullif(hi_{c} - lo_{c}, 0), 9) + 0.0::double as {c}" for c in numbers) + f" from {source}, ranges"


def ranges_sql(source, numbers, test):
    return "ranges as (select " + ", ".join(f"min({c}) as lo_{c}, max({c}) as hi_{c}" for c in numbers) + f" from {source} where not {test})"


def house_sql(caps):
    capped = lambda c: f"case when {c} > {caps[c]} then {caps[c]} else {c} end" if c in caps else c
    nums = ["quantity", "size", "retail", "quantity_ratio", "brand_code"]
    test = is_test_sql("sale_id")
    return f"""with {HOUSE}, c as (select distinct sale_id, line, price, brand, kind, {capped('quantity')} as quantity, {capped('size')} as size, {capped('retail')} as retail, sold_at from house where price > 0),
      e as (select *, quantity / size as quantity_ratio, month(sold_at) as mo from c),
      m as (select brand, avg(price) as m from e where not {test} group by brand), o as (select brand, (row_number() over (order by m, brand) - 1)::double as brand_code from m),
      p as (select e.*, o.brand_code from e left join o using (brand)), {ranges_sql('p', nums, test)}
      select sale_id, line, price, (mo in (3, 4, 5))::int as season_spring, (mo in (6, 7, 8))::int as season_summer, (mo in (12, 1, 2))::int as season_winter, {prepared_sql('p', nums)} where {test}"""


def prepared(df, key, recipe):
    train, test = halves(df, key)
    return r(prepare.fit(recipe, train).apply(test), *recipe.numeric, digits=9)


CAPS = {"quantity": 40.0, "retail": 1500.0}


@query("fe7_prepare_house", house_sql({}))
def _(t):
    return prepared(house(t), "sale_id", recipes.house())


@query("fe7_prepare_house_capped", house_sql(CAPS))
def _(t):
    return prepared(house(t), "sale_id", recipes.house(CAPS))


def credit_sql(amount, balance, rank):
    nums = ["amount", "balance", "rank", "years", "nation_ratio"]
    test = is_test_sql("loan_id")
    return f"""with {LOANS}, s as (select *, {STATUS_SQL} as target, substr(priority, 1, 1)::double as rank_, (2020 - year(issued))::double as years from loans where loan_status in ('F', 'O')),
      e as (select loan_id, target, nation, segment, years, {amount} as amount, {balance} as balance, {rank} as rank from s),
      f as (select nation, nullif(count(*) filter (target = 1), 0)::double / nullif(count(*) filter (target = 0), 0) as nr from e where not {test} group by nation),
      j as (select e.*, f.nr from e left join f using (nation)), md as (select median(amount) as ma, median(balance) as mb, median(nr) as mn from j where not {test}),
      p as (select loan_id, target, segment, coalesce(amount, ma) as amount, coalesce(balance, mb) as balance, rank, years, coalesce(nr, mn) as nation_ratio from j, md), {ranges_sql('p', nums, test)}
      select loan_id, target, (segment = 'BUILDING')::int as "segment_BUILDING", (segment = 'FURNITURE')::int as "segment_FURNITURE",
      (segment = 'HOUSEHOLD')::int as "segment_HOUSEHOLD", (segment = 'MACHINERY')::int as "segment_MACHINERY", {prepared_sql('p', nums)} where {test}"""


@query("fe8_prepare_credit", credit_sql("amount", "balance", "rank_"))
def _(t):
    return prepared(loans(t), "loan_id", recipes.credit())


@query("fe9_prepare_credit_limited", credit_sql("case when amount < 400000 then amount else 400000 end", "case when balance <= 0 then 0 when balance >= 8000 then 8000 else balance end",
                                                "case when rank_ <= 3 then 0.0::double else 1.0::double end"))
def _(t):
    return prepared(loans(t), "loan_id", recipes.credit_limited())


PASSENGERS = """pas as (select o_orderkey as passenger, (o_orderstatus = 'F')::int as survived, case when o_orderkey % 7 = 0 then null else (o_orderkey % 80)::double end as age,
  case when o_orderkey % 11 = 0 then null else o_totalprice end as fare, case when o_orderkey % 13 = 0 then null else o_orderstatus end as port from orders)"""


def passengers(t):
    k = F.col("o_orderkey")
    return t.orders.select(
        k.alias("passenger"), (F.col("o_orderstatus") == "F").cast("int").alias("survived"),
        F.when(k % 7 == 0, "?").otherwise((k % 80).cast("string")).alias("age"),
        F.when(k % 11 == 0, "?").otherwise(F.col("o_totalprice").cast("string")).alias("fare"),
        F.when(k % 13 == 0, "?").otherwise(F.col("o_orderstatus")).alias("port"))


@query("fe10_prepare_passengers", f"""with {PASSENGERS}, md as (select median(age) as ma, median(fare) as mf from pas where not {is_test_sql('passenger')}),
  p as (select passenger, survived, port, coalesce(age, ma) as age, coalesce(fare, mf) as fare from pas, md), {ranges_sql('p', ['age', 'fare'], is_test_sql('passenger'))}
  select passenger, survived, coalesce((port = 'O')::int, 0) as "port_O", coalesce((port = 'P')::int, 0) as "port_P", {prepared_sql('p', ['age', 'fare'])} where {is_test_sql('passenger')}""")
def _(t):
    return prepared(passengers(t), "passenger", recipes.passengers())


@query("fe11_index_ids", f"""with {TRANSACTIONS} select item, dense_rank() over (order by item) - 1 as index from (select distinct item from transactions)""")
def _(t):
    return encode.index_ids(transactions(t), "item")


def credit_frame(t):
    """The prepared loans of all rows, with the fit taken from the training part."""
    rows = loans(t)
    fitted = prepare.fit(recipes.credit(), rows.filter(~is_test("loan_id")))
    return fitted.apply(rows), fitted.features


@query("fe12_forward_select")
def _(t):
    df, features = credit_frame(t)
    chosen = M.forward_select(df, "target", features)
    return t.spark.createDataFrame([(i, c) for i, c in enumerate(chosen)], "step int, feature string")


@query("fe13_backward_eliminate")
def _(t):
    df, features = credit_frame(t)
    return t.spark.createDataFrame([(c,) for c in M.backward_eliminate(df, "target", features)], "feature string")


@query("fe14_best_features", f"with {HOUSE} select sale_id, line, quantity, retail from house")
def _(t):
    return house(t).select("sale_id", "line", "quantity", "retail")


@query("io13_saved_fit", house_sql({}))
def _(t):
    train, test = halves(house(t), "sale_id")
    path = new_path(t.spark, "fit")
    prepare.fit(recipes.house(), train).save(t.spark, path)
    return r(prepare.load(t.spark, recipes.house(), path).apply(test), *recipes.house().numeric, digits=9)


# --- models ------------------------------------------------------------------------------------

@query("ml1_ols", f"""with {HOUSE}, s as (select regr_slope(price, quantity) as b, regr_intercept(price, quantity) as a, regr_r2(price, quantity) as r2, count(*) as n,
    regr_sxx(price, quantity) as sxx, avg(quantity) as mx, regr_syy(price, quantity) as syy from house), e as (select *, sqrt((1 - r2) * syy / (n - 2)) as se from s)
  select 'quantity' as term, round(b, 4) as estimate, round(se / sqrt(sxx), 4) as std_error, round(b / (se / sqrt(sxx)), 2) as t, round(r2, 6) as r2 from e
  union all select 'const', round(a, 4), round(se * sqrt(1.0::double / n + mx * mx / sxx), 4), round(a / (se * sqrt(1.0::double / n + mx * mx / sxx)), 2), round(r2, 6) from e""")
def _(t):
    out = M.ols(house(t), "price", ["quantity"])
    return r(r(r(out, "estimate", "std_error", digits=4), "t", digits=2), "r2").drop("p")


@query("ml1_ols_many")
def _(t):
    return M.ols(house(t), "price", NUM)


#: Spreads of the three numbers and their covariances with the price, and the determinant of the spreads.
NORMAL = f"""with {HOUSE}, s as (select count(*) as n, var_pop(quantity) as a, covar_pop(quantity, size) as b, covar_pop(quantity, retail) as c, var_pop(size) as d, covar_pop(size, retail) as e, var_pop(retail) as f,
    covar_pop(price, quantity) as u, covar_pop(price, size) as v, covar_pop(price, retail) as w, var_pop(price) as y, avg(price) as my, avg(quantity) as m1, avg(size) as m2, avg(retail) as m3 from house),
  i as (select *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) as det from s),
  k as (select *, (u * (d * f - e * e) + v * (c * e - b * f) + w * (b * e - c * d)) / det as k1, (u * (c * e - b * f) + v * (a * f - c * c) + w * (b * c - a * e)) / det as k2,
    (u * (b * e - c * d) + v * (b * c - a * e) + w * (a * d - b * b)) / det as k3 from i)"""


@query("ml1_ols_estimates", f"""{NORMAL}, g as (select *, y - (k1 * u + k2 * v + k3 * w) as rest from k), h as (select *, rest * n / (n - 4) / n / det as q from g)
  select term, round(estimate, 4) + 0.0::double as estimate, round(std_error, 4) as std_error, round(1 - rest / y, 8) as r2 from (
    select 'quantity' as term, k1 as estimate, sqrt(q * (d * f - e * e)) as std_error, rest, y from h union all select 'size', k2, sqrt(q * (a * f - c * c)), rest, y from h
    union all select 'retail', k3, sqrt(q * (a * d - b * b)), rest, y from h
    union all select 'const', my - k1 * m1 - k2 * m2 - k3 * m3, sqrt(rest / (n - 4) + q * (m1 * m1 * (d * f - e * e) + m2 * m2 * (a * f - c * c) + m3 * m3 * (a * d - b * b)
      + 2 * m1 * m2 * (c * e - b * f) + 2 * m1 * m3 * (b * e - c * d) + 2 * m2 * m3 * (b * c - a * e))), rest, y from h)""")
def _(t):
    """What of the least-squares table has a closed form."""
    return r(r(M.ols(house(t), "price", NUM), "estimate", "std_error", digits=4), "r2", digits=8).select("term", "estimate", "std_error", "r2")


@query("ml2_linear_coefficients", f"""{NORMAL} select 'quantity' as feature, round(k1, 4) + 0.0::double as coefficient from k union all select 'size', round(k2, 4) + 0.0::double from k
  union all select 'retail', round(k3, 4) + 0.0::double from k""")
def _(t):
    return r(M.linear_coefficients(house(t), "price", NUM), "coefficient", digits=4)


@query("ml3_logit_inference")
def _(t):
    df, features = credit_frame(t)
    return M.logit_inference(df, "target", features)


@query("ml4_logistic")
def _(t):
    df, features = credit_frame(t)
    return M.odds_table(df, M.fit_logistic(df.filter(~is_test("loan_id")), "target", features), features)


def regress(t, estimator):
    train, test = halves(house(t), "sale_id")
    return M.fit_score(estimator, train, test, "price", NUM, ["sale_id", "line"])


@query("ml5_tree_regressor")
def _(t):
    return E.regression_metrics(regress(t, M.tree_regressor("price"))[1], "price", "prediction")


@query("ml6_forest_regressor")
def _(t):
    return E.regression_metrics(regress(t, M.forest_regressor("price"))[1], "price", "prediction")


@query("ml7_gbt_regressor")
def _(t):
    """The model is saved, read back, and scored on the test rows."""
    train, test = halves(house(t), "sale_id")
    model = M.saved(M.fit_binned(M.gbt_regressor("price"), train, "price", NUM), new_path(t.spark, "gbt"))
    return E.regression_metrics(M.score_binned(model, test, NUM, ["price"]), "price", "prediction")


def classify(t, estimator):
    df, features = credit_frame(t)
    train, test = halves(df, "loan_id")
    return M.fit_score(estimator, train, test, "target", features, ["loan_id"])[1].withColumn("yhat", F.col("prediction").cast("int"))


@query("ml8_tree_classifier")
def _(t):
    return E.classification_report(classify(t, M.tree_classifier("target")), "target", "yhat", [0, 1])


@query("ml9_forest_classifier")
def _(t):
    return E.classification_report(classify(t, M.forest_classifier("target")), "target", "yhat", [0, 1])


@query("ml10_gbt_classifier")
def _(t):
    return E.classification_report(classify(t, M.gbt_classifier("target")), "target", "yhat", [0, 1])


@query("ml11_boosted_classifier")
def _(t):
    return E.classification_report(classify(t, M.gbt_classifier("target", depth=3, rate=0.3)), "target", "yhat", [0, 1])


@query("ml12_gaussian_nb", f"""with d as (select doc_id, quality as y, ln(n_chars) as a, length(source)::double as b from labels join documents using (doc_id)),
  s as (select max(v) * 1e-9::double as eps from (select var_pop(a) as v from d union all select var_pop(b) from d)),
  c as (select y, ln(count(*)::double / (select count(*) from d)) as prior, avg(a) as ma, avg(b) as mb, var_pop(a) + max(eps) as va, var_pop(b) + max(eps) as vb from d, s group by y),
  p as (select doc_id, d.y, c.y as k, prior - 0.5 * (ln(2 * pi() * va) + (a - ma) ** 2 / va + ln(2 * pi() * vb) + (b - mb) ** 2 / vb) as score from d, c)
  select doc_id, y, arg_max(k, score) as predicted from p group by doc_id, y""")
def _(t):
    d = t.labels.join(t.documents, "doc_id").select("doc_id", F.col("quality").alias("y"), F.ln("n_chars").alias("a"), F.length("source").cast("double").alias("b"))
    _, scored = M.fit_score(M.gaussian_nb("y"), d, d, "y", ["a", "b"], ["doc_id"])
    return scored.select("doc_id", "y", F.col("prediction").cast("int").alias("predicted"))


@query("ml13_predict_proba")
def _(t):
    df, features = credit_frame(t)
    train, test = halves(df, "loan_id")
    return M.predict_proba(M.fit_logistic(train, "target", features), test, features, ["loan_id"])


@query("pf25_row_scoring")
def _(t):
    """New rows go through the preparation and the model as they are read back from where they were saved."""
    rows = loans(t)
    fitted = prepare.fit(recipes.credit(), rows.filter(~is_test("loan_id")))
    model = M.saved(M.fit_logistic(fitted.apply(rows.filter(~is_test("loan_id"))), "target", fitted.features), new_path(t.spark, "logit"))
    fitted.save(t.spark, path := new_path(t.spark, "credit"))
    fitted = prepare.load(t.spark, recipes.credit(), path)
    scored = M.predict_proba(model, fitted.apply(rows), fitted.features, ["loan_id"])
    return scored.withColumn("approved", C.threshold_predict(F.col("probability"), 0.5))


@query("ml14_feature_importance")
def _(t):
    model, _ = regress(t, M.tree_regressor("price"))
    return M.feature_importance(t.lineitem, model, NUM)


def vectors(t):
    return M.assemble_array(t.embeddings, "embedding", ["vec_id", "label"])


@query("ml15_kmeans")
def _(t):
    v = vectors(t)
    return M.kmeans(v, 10).transform(v).select("vec_id", "label", F.col("prediction").alias("cluster"))


@query("ml15_saved_clusters")
def _(t):
    """New rows find the nearest of the centres that were saved."""
    v = vectors(t)
    model = M.saved(M.kmeans(v.filter(~is_test("vec_id")), 10), new_path(t.spark, "kmeans"))
    return model.transform(v.filter(is_test("vec_id"))).select("vec_id", "label", F.col("prediction").alias("cluster"))


@query("ml16_elbow")
def _(t):
    return M.elbow(vectors(t), list(range(1, 11)))


@query("ml16_single_cluster", """with e as (select unnest(embedding)::double as x, generate_subscripts(embedding, 1) as d from embeddings)
  select round(sum(s), 4) as cost from (select var_pop(x) * count(*) as s from e group by d)""")
def _(t):
    return r(M.total_spread(vectors(t)), "cost", digits=4)


@query("ml17_gaussian_mixtures")
def _(t):
    reduced, _ = M.principal_components(vectors(t), k=4)
    return M.gaussian_mixtures(M.assemble_array(reduced, "scores", ["vec_id"]), list(range(1, 20)))


@query("ml18_hierarchical")
def _(t):
    v = vectors(t)
    return M.hierarchical(v, 10).transform(v).select("vec_id", "label", F.col("prediction").alias("cluster"))


@query("ml19_pca")
def _(t):
    scores, _ = M.principal_components(vectors(t), share=0.8)
    return scores.select("vec_id", "label", "scores")


@query("st15_explained_variance")
def _(t):
    _, ratios = M.principal_components(vectors(t), k=64)
    running, reached = X.explained_variance(ratios)
    return t.spark.createDataFrame([(i + 1, a, b, i + 1 >= reached) for i, (a, b) in enumerate(zip(ratios, running))],
                                   "k int, ratio double, cumulative double, reached boolean")


@query("ml20_svd")
def _(t):
    _, scores = M.singular_values(vectors(t), 8)
    return scores.select("vec_id", "scores")


@query("ml21_lag_forecast")
def _(t):
    return forecast.lag_forecast(bars(t), "2024-01-22")


@query("ml22_embedding_reduction")
def _(t):
    scores, _ = M.principal_components(vectors(t), k=15)
    return scores.select("vec_id", "scores")


@query("ml23_cluster_view")
def _(t):
    v = vectors(t)
    two, _ = M.principal_components(v, k=2)
    clusters = M.kmeans(v, 10).transform(v).select("vec_id", F.col("prediction").alias("cluster"))
    return (two.join(clusters, "vec_id").select("vec_id", "label", "cluster", F.col("scores")[0].alias("x"), F.col("scores")[1].alias("y")))


@query("ml25_cluster_medians", f"""with {CLUSTERED} select cluster, round(median(embedding[1]::double), 6) as x, round(median(embedding[2]::double), 6) as y from clustered group by cluster""")
def _(t):
    c = clustered(t).select("cluster", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    q = quantiles_wide(c, ["x", "y"], {"m": .5}, ["cluster"])
    return r(q.groupBy("cluster").agg(*[F.max(F.when(F.col("column") == n, F.col("m"))).alias(n) for n in ("x", "y")]), "x", "y")


@query("ev2_cross_validate")
def _(t):
    folds = split.consecutive_folds(house(t).select("sale_id", "line", "price", *NUM), ["sale_id", "line", "price", *NUM], 5)
    return M.cross_validate(folds, "price", NUM, "fold", 5)


@query("ev2_cross_validate_means", f"""with {HOUSE}, f as (select price, quantity, ntile(5) over (order by sale_id, line, price, quantity, size, retail) - 1 as fold from house),
  fit as (select k as fold, regr_slope(price, quantity) as a, regr_intercept(price, quantity) as b from f, range(5) r(k) where f.fold <> k group by k),
  m as (select fold, avg(price) as m from f group by fold), e as (select fold, price - (a * quantity + b) as e, price - m as d from f join fit using (fold) join m using (fold)),
  s as (select fold, 1 - sum(e * e) / sum(d * d) as r2, sqrt(avg(e * e)) as rmse from e group by fold)
  select round(avg(r2), 4) + 0.0::double as mean_r2, round(avg(rmse), 4) as mean_rmse from s""")
def _(t):
    folds = split.consecutive_folds(house(t).select("sale_id", "line", "price", *NUM), ["sale_id", "line", "price", *NUM], 5)
    return r(M.fold_means(M.cross_validate(folds, "price", ["quantity"], "fold", 5)), "mean_r2", "mean_rmse", digits=4)


@query("ev2_cross_validate_line", f"""with {HOUSE}, f as (select price, quantity, ntile(5) over (order by sale_id, line, price, quantity, size, retail) - 1 as fold from house),
  fit as (select k as fold, regr_slope(price, quantity) as a, regr_intercept(price, quantity) as b from f, range(5) r(k) where f.fold <> k group by k),
  m as (select fold, avg(price) as m from f group by fold), e as (select fold, price - (a * quantity + b) as e, price - m as d from f join fit using (fold) join m using (fold))
  select fold::int as fold, round(1 - sum(e * e) / sum(d * d), 4) + 0.0::double as r2, round(sqrt(avg(e * e)), 4) as rmse from e group by fold""")
def _(t):
    folds = split.consecutive_folds(house(t).select("sale_id", "line", "price", *NUM), ["sale_id", "line", "price", *NUM], 5)
    return r(M.cross_validate(folds, "price", ["quantity"], "fold", 5), "r2", digits=4)
