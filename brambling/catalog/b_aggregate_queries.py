"""Aggregations, reports, pivots, sorts, limits, set operations, splits."""

from pyspark.sql import functions as F

from brambling.catalog.inputs import (CLUSTERED, DAILY, HOUSE, LOANS, STATUS, STATUS_SQL, TRANSACTIONS,
                                      clustered, daily, house, is_test, is_test_sql, loans, transactions)
from brambling.catalog.registry import query
from brambling.functions import columns as C
from brambling.operators import aggregate as A, encode, ordering, split
from brambling.sources.tables import spread

HASH = lambda c, seed=42: f"('0x' || substr(md5(cast({c} as varchar) || '|{seed}'), 1, 8))::BIGINT"


def r(df, *names, digits=4):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("ag1_group_mean", f"with {HOUSE} select brand, round(avg(price), 4) as mean from house group by brand")
def _(t):
    return r(A.group_mean(house(t), ["brand"], "price"), "mean")


@query("ag2_group_max", "select source, max(n_chars) as best from documents group by source")
def _(t):
    return A.group_max(t.documents, "source", "n_chars")


@query("ag3_group_count", "select source, lang, count(*) as n from documents group by all")
def _(t):
    return A.group_count(t.documents, ["source", "lang"])


@query("ag4_group_sum_pivot", """select year(o_orderdate)::int as year, round(sum(o_totalprice) filter (o_orderstatus = 'F'), 2) as F,
  round(sum(o_totalprice) filter (o_orderstatus = 'O'), 2) as O, round(sum(o_totalprice) filter (o_orderstatus = 'P'), 2) as P
  from orders group by 1""")
def _(t):
    o = t.orders.select(F.year("o_orderdate").alias("year"), "o_orderstatus", "o_totalprice")
    return r(A.group_sum_pivot(o, "year", "o_orderstatus", ["F", "O", "P"], "o_totalprice"), "F", "O", "P", digits=2).orderBy("year")


@query("ag5_value_counts", "select p_type, count(*) as n from part group by 1")
def _(t):
    return A.value_counts(t.part, "p_type")


@query("ag6_share", "select lang, count(*) as n, round(count(*) * 100.0 / sum(count(*)) over (), 6)::double as percent from documents group by lang")
def _(t):
    return r(A.share(t.documents, "lang"), "percent", digits=6)


@query("ag7_distinct_counts", f"""with {LOANS} select 'amount' as "column", count(distinct amount) + max((amount is null)::int) as n_distinct from loans
  union all select 'segment', count(distinct segment) + max((segment is null)::int) from loans
  union all select 'nation', count(distinct nation) + max((nation is null)::int) from loans
  union all select 'balance', count(distinct balance) + max((balance is null)::int) from loans""")
def _(t):
    return A.distinct_counts(loans(t), ["amount", "segment", "nation", "balance"])


@query("ag8_missing_report", f"""with {LOANS} select 'amount' as "column", count(*) - count(amount) as missing, round((count(*) - count(amount)) * 100.0 / count(*), 6)::double as percent from loans
  union all select 'balance', count(*) - count(balance), round((count(*) - count(balance)) * 100.0 / count(*), 6)::double from loans
  union all select 'segment', count(*) - count(segment), round((count(*) - count(segment)) * 100.0 / count(*), 6)::double from loans""")
def _(t):
    return r(A.missing_report(loans(t), ["amount", "balance", "segment"]), "percent", digits=6)


@query("ag9_describe", f"""with {LOANS}, w as (select 'segment' as "column", segment as v from loans union all select 'priority', priority from loans),
  c as (select "column", v, count(*) as n from w group by all)
  select "column", count, round(mean, 4) as mean, round(std, 4) as std, min, max, round(q1, 4) as q1, round(median, 4) as median, round(q3, 4) as q3,
    null::bigint as "unique", null as top, null::bigint as freq from (
    select 'amount' as "column", count(amount) as count, avg(amount) as mean, stddev_samp(amount) as std, min(amount) as min, max(amount) as max,
      quantile_cont(amount, .25) as q1, quantile_cont(amount, .5) as median, quantile_cont(amount, .75) as q3 from loans
    union all select 'balance', count(balance), avg(balance), stddev_samp(balance), min(balance), max(balance),
      quantile_cont(balance, .25), quantile_cont(balance, .5), quantile_cont(balance, .75) from loans)
  union all select "column", sum(n)::bigint, null, null, null, null, null, null, null, count(*), arg_min(v, (-n, v)), max(n) from c group by "column" """)
def _(t):
    return r(A.describe(loans(t), ["amount", "balance"], ["segment", "priority"]), "mean", "std", "q1", "median", "q3")


@query("ag10_pivot_mean", f"""with {TRANSACTIONS} select item, "user", round(avg(quantity), 6) as value from transactions group by item, "user" """)
def _(t):
    return r(A.pivot_mean(transactions(t), "item", "user", "quantity"), "value", digits=6)


@query("ag11_unique", "select distinct l_partkey from lineitem")
def _(t):
    return t.lineitem.select("l_partkey").distinct()


@query("ag12_row_mean", f"""with {LOANS} select loan_id, round((coalesce(amount, 0) + coalesce(balance, 0)) /
  nullif((amount is not null)::int + (balance is not null)::int, 0), 4) as mean from loans""")
def _(t):
    return r(loans(t).select("loan_id", A.row_mean([F.col("amount"), F.col("balance")]).alias("mean")), "mean")


@query("ag13_class_ratio", f"""with {LOANS}, fit as (select segment, nullif(count(*) filter ({STATUS_SQL} = 1), 0)::double
  / nullif(count(*) filter ({STATUS_SQL} = 0), 0) as ratio from loans where not {is_test_sql('loan_id')} group by segment)
  select loan_id, segment, round(ratio, 6) as ratio from loans left join fit using (segment) where {is_test_sql('loan_id')}""")
def _(t):
    rows = loans(t).withColumn("y", C.map_values(F.col("loan_status"), STATUS))
    fit = encode.fit_class_ratio(rows.filter(~is_test("loan_id")), "segment", "y")
    return r(encode.apply_lookup(rows.filter(is_test("loan_id")).select("loan_id", "segment"), fit, "segment"), "ratio", digits=6)


@query("ag14_mode_per_class", f"""with {CLUSTERED}, c as (select label, cluster, count(*) as n from clustered group by all),
  m as (select label, arg_min(cluster, (-n, cluster)) as cluster from c group by label)
  select label, cluster, max(label) over (partition by cluster) as mapped_label from m""")
def _(t):
    return A.mode_per_class(clustered(t), "label", "cluster")


@query("ag16_term_frequency", """with w as (select lang, unnest(string_split_regex(lower(text), '[^a-zà-ÿ]+')) as term from documents),
  c as (select lang, term, count(*) as n from w where term <> '' group by all)
  select lang, term, n, row_number() over (partition by lang order by n desc, term) as rank from c qualify rank <= 500""")
def _(t):
    d = spread(t.documents).select("lang", F.split(F.lower("text"), "[^a-zà-ÿ]+").alias("terms"))
    return A.term_frequency(d, "lang", "terms", 500)


@query("ag17_group_distribution", f"""with {HOUSE}, l as (select brand, 'price' as "column", price as v from house union all select brand, 'size', size from house),
  q as (select brand, "column", quantile_cont(v, .25) as q1, quantile_cont(v, .5) as median, quantile_cont(v, .75) as q3 from l group by all)
  select brand, "column", round(q1, 4) as q1, round(median, 4) as median, round(q3, 4) as q3,
    min(v) filter (v >= q1 - 1.5 * (q3 - q1)) as low_whisker, max(v) filter (v <= q3 + 1.5 * (q3 - q1)) as high_whisker
  from l join q using (brand, "column") group by all""")
def _(t):
    return r(A.group_distribution(house(t), "brand", ["price", "size"]), "q1", "median", "q3")


@query("ag18_score_and_count", """with d as (select source, lang, n_chars / 100.0::double as s from documents),
  p as (select source, lang, max(s) as score, count(*) as n from d group by all)
  select source, round(sum(score) / 4, 6) as avg_sim, round(sum(n) / 4, 6) as avg_count, round(sum(score) / 4 * (sum(n) / 4), 6) as total_score from p group by source""")
def _(t):
    d = t.documents.select("source", "lang", (F.col("n_chars") / 100.0).alias("s"))
    return r(A.score_and_count(d, "source", "lang", "s", 4), "avg_sim", "avg_count", "total_score", digits=6)


@query("ag19_shape", "select count(*) as rows, 11::bigint as columns from lineitem")
def _(t):
    return A.shape(t.lineitem)


# --- sorts, limits, sets ---------------------------------------------------------------------

@query("so1_sort_desc", "select p_partkey, p_retailprice from part")
def _(t):
    return t.part.select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey")


@query("so2_top_k", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 5")
def _(t):
    return ordering.top_k(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 5)


@query("so3_top_k_per_group", """select o_custkey, o_orderkey, o_totalprice, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rank
  from orders qualify rank <= 10""")
def _(t):
    return ordering.top_k_per_group(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"],
                                    [F.desc("o_totalprice"), F.col("o_orderkey")], 10)


@query("so4_cap_rows", "select l_partkey, count(*) as n from lineitem group by 1 order by n desc, l_partkey limit 30000")
def _(t):
    return ordering.top_k(A.group_count(t.lineitem, ["l_partkey"]), [F.desc("n"), "l_partkey"], 30000)


@query("so5_union_all", "select doc_id as id, text from documents union all select item_id, text from benchmark")
def _(t):
    return t.documents.select(F.col("doc_id").alias("id"), "text").unionByName(
        t.benchmark.select(F.col("item_id").alias("id"), "text"))


@query("so6_union_distinct", "select text from documents union select text from benchmark union select text from conversations")
def _(t):
    return (t.documents.select("text").unionByName(t.benchmark.select("text"))
            .unionByName(t.conversations.select("text")).distinct())


@query("so7_set_minus", f"""select o_custkey from orders where not {is_test_sql('o_orderkey')} except select o_custkey from orders where {is_test_sql('o_orderkey')}""")
def _(t):
    o = t.orders.select("o_orderkey", "o_custkey")
    return split.missing_categories(o.filter(~is_test("o_orderkey")), o.filter(is_test("o_orderkey")), "o_custkey")


@query("so8_split", f"select o_orderkey, {HASH('o_orderkey')} % 100 < 20 as is_test from orders")
def _(t):
    return split.hash_split(t.orders.select("o_orderkey"), "o_orderkey")


@query("so9_stratified_split", f"""select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus order by {HASH('o_orderkey')}, o_orderkey)
  <= floor(count(*) over (partition by o_orderstatus) * 0.2::double) as is_test from orders""")
def _(t):
    return split.stratified_split(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus")


@query("so10_sample", f"select o_orderkey, o_totalprice from orders order by {HASH('o_orderkey')}, o_orderkey limit 30000")
def _(t):
    return split.sample_rows(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 30000)


@query("so11_kfold", "select o_orderkey, ntile(7) over (order by o_orderkey) - 1 as fold from orders")
def _(t):
    return split.consecutive_folds(t.orders.select("o_orderkey"), ["o_orderkey"], 7)


@query("so12_head", "select * from customer order by c_custkey limit 5")
def _(t):
    return ordering.top_k(t.customer, ["c_custkey"], 5)


@query("so13_position_slice", """select o_orderkey, 'valid' as part from orders qualify row_number() over (order by o_orderkey) <= 5000
  union all select o_orderkey, 'train' from orders qualify row_number() over (order by o_orderkey) > 6000""")
def _(t):
    o = ordering.number_rows(t.orders.select("o_orderkey"), ["o_orderkey"], "rn")
    part = F.when(F.col("rn") <= 5000, "valid").when(F.col("rn") > 6000, "train")
    return o.withColumn("part", part).filter(F.col("part").isNotNull()).select("o_orderkey", "part")


@query("so14_time_split", f"""with {DAILY} select symbol, date, close, case when date between date '2024-01-05' and date '2024-01-19' then 'train' else 'test' end as part
  from daily where date between date '2024-01-05' and date '2024-01-29'""")
def _(t):
    # 6 January is a Saturday (moves to the 5th), 20 January too, 28 January is a Sunday
    return split.time_split(daily(t), "date", "2024-01-06", "2024-01-20", "2024-01-28")
