"""Projections, filters, cleansing; lookups and merges."""

from pyspark.sql import functions as F

from brambling.catalog.inputs import (HOUSE, LOANS, STATUS, STATUS_SQL, SCORED, TRANSACTIONS, clustered, CLUSTERED,
                                      house, is_test, is_test_sql, loans, scored, transactions)
from brambling.catalog.registry import query
from brambling.functions import columns as C
from brambling.operators import cleanse, lookup

PRIORITY = {"1-URGENT": 1.0, "2-HIGH": 2.0, "3-MEDIUM": 3.0, "5-LOW": 5.0}
PRIORITY_SQL = ("case trim(priority) when '1-URGENT' then 1.0::double when '2-HIGH' then 2.0::double "
                "when '3-MEDIUM' then 3.0::double when '5-LOW' then 5.0::double end")


@query("pf1_rename", "select c_custkey as customer, c_acctbal as balance, c_mktsegment from customer")
def _(t):
    return cleanse.rename(t.customer, {"c_custkey": "customer", "c_acctbal": "balance"}).select(
        "customer", "balance", "c_mktsegment")


@query("pf2_select_features", "select o_orderkey, o_totalprice from orders")
def _(t):
    return cleanse.select_features(t.orders, ["o_orderkey", "o_totalprice"])


@query("pf3_filter_positive", "select c_custkey, c_acctbal from customer where c_acctbal > 0")
def _(t):
    return cleanse.filter_positive(t.customer, "c_acctbal").select("c_custkey", "c_acctbal")


@query("pf4_filter_in", "select o_orderkey, o_orderstatus from orders where o_orderstatus in ('F', 'O')")
def _(t):
    return cleanse.filter_in(t.orders, "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderstatus")


@query("pf5_cast_schema", """select o_orderkey, case when o_orderkey % 11 = 0 then null else o_totalprice end as as_double,
  cast(trunc(o_totalprice) as bigint) as as_long from orders""")
def _(t):
    text = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("as_double"),
        F.col("o_totalprice").alias("as_long"))
    return cleanse.cast_schema(text, {"as_double": "double", "as_long": "bigint"})


@query("pf6_dedupe_rows", "select distinct o_custkey, o_orderstatus, o_orderpriority from orders")
def _(t):
    return cleanse.dedupe_rows(t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority"))


@query("pf7_null_token", """select c_custkey, case when c_custkey % 7 = 0 then null else c_name end as c_name,
  case when c_custkey % 5 = 0 then null else c_mktsegment end as c_mktsegment from customer""")
def _(t):
    marked = t.customer.select(
        "c_custkey", F.when(F.col("c_custkey") % 7 == 0, "?").otherwise(F.col("c_name")).alias("c_name"),
        F.when(F.col("c_custkey") % 5 == 0, "?").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return cleanse.null_tokens(marked, ["c_name", "c_mktsegment"])


@query("pf8_map_values", f"with {LOANS} select loan_id, {PRIORITY_SQL} as years from loans")
def _(t):
    return loans(t).select("loan_id", C.map_values(F.concat(F.lit(" "), "priority", F.lit(" ")), PRIORITY).alias("years"))


@query("pf9_target_label", f"with {LOANS} select loan_id, {STATUS_SQL} as target from loans")
def _(t):
    return loans(t).select("loan_id", C.map_values(F.col("loan_status"), STATUS).alias("target"))


@query("pf10_cap_max", f"with {LOANS} select loan_id, case when amount < 200000 then amount else 200000 end as amount from loans")
def _(t):
    return loans(t).select("loan_id", C.cap_max(F.col("amount"), 200000.0).alias("amount"))


@query("pf11_binarize", f"with {LOANS} select loan_id, case when balance <= 1000 then 0 else 1 end as flag from loans")
def _(t):
    return loans(t).select("loan_id", C.binarize(F.col("balance"), 1000.0).alias("flag"))


@query("pf12_winsorize", f"""with {LOANS} select loan_id, case when balance <= 0 then 0.0::double
  when balance >= 5000 then 5000.0::double else balance end as balance from loans""")
def _(t):
    return loans(t).select("loan_id", C.winsorize(F.col("balance"), 0.0, 5000.0).alias("balance"))


@query("pf13_cap_dict", f"""with {LOANS} select loan_id, case when amount > 300000 then 300000.0::double else amount end as amount,
  case when balance > 4000 then 4000.0::double else balance end as balance from loans""")
def _(t):
    return cleanse.cap_dict(loans(t).select("loan_id", "amount", "balance"), {"amount": 300000.0, "balance": 4000.0})


@query("pf14_ratio", """select o_orderkey, round(case when o_orderkey % 3 = 0 then null else o_totalprice / (o_orderkey % 3) end, 4)
  as ratio from orders""")
def _(t):
    return t.orders.select("o_orderkey", F.round(C.ratio(F.col("o_totalprice"), F.col("o_orderkey") % 3), 4).alias("ratio"))


@query("pf15_log_target", "select l_orderkey, l_linenumber, round(ln(l_extendedprice), 6) as log_price from lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(C.log_target(F.col("l_extendedprice")), 6).alias("log_price"))


@query("pf16_month_year", """select o_orderkey, month(o_orderdate)::int as month, year(o_orderdate)::int as year from orders""")
def _(t):
    at = F.to_timestamp(F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss"), "yyyyMMdd'T'HHmmss")
    return t.orders.select("o_orderkey", F.month(at).alias("month"), F.year(at).alias("year"))


@query("pf17_season", """select o_orderkey, case when month(o_orderdate) in (12, 1, 2) then 'winter'
  when month(o_orderdate) in (3, 4, 5) then 'spring' when month(o_orderdate) in (6, 7, 8) then 'summer'
  when month(o_orderdate) in (9, 10, 11) then 'autum' else 'NA' end as season from orders""")
def _(t):
    return t.orders.select("o_orderkey", C.season(F.month("o_orderdate")).alias("season"))


@query("pf18_parse_mon_yy", """select o_orderkey, (date_trunc('month', case when o_orderkey % 4 = 0
  then o_orderdate - interval 25 year else o_orderdate end))::date as opened from orders""")
def _(t):
    moved = F.when(F.col("o_orderkey") % 4 == 0, F.add_months(F.to_date("o_orderdate"), -300)).otherwise(F.to_date("o_orderdate"))
    return t.orders.select("o_orderkey", C.parse_mon_yy(F.date_format(moved, "MMM-yy")).alias("opened"))


@query("pf19_years_between", "select o_orderkey, (2020 - year(o_orderdate))::int as years from orders")
def _(t):
    return t.orders.select("o_orderkey", C.years_between(F.lit("2020-06-30").cast("date"), F.col("o_orderdate")).alias("years"))


@query("pf20_business_day", """select o_orderkey, (case isodow(o_orderdate) when 6 then o_orderdate::date - 1
  when 7 then o_orderdate::date + 1 else o_orderdate::date end)::date as day from orders""")
def _(t):
    return t.orders.select("o_orderkey", C.business_day(F.to_date("o_orderdate")).alias("day"))


@query("pf21_rescale_const", """select vec_id, round(list_sum(list_transform(embedding, lambda x: x::double / 255)), 6) as total,
  round(embedding[1]::double / 255, 9) as head, len(embedding)::int as width from embeddings""")
def _(t):
    v = C.rescale(F.col("embedding"), 255.0)
    return t.embeddings.select("vec_id", v.alias("v")).select(
        "vec_id", F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
        F.round(F.col("v")[0], 9).alias("head"), F.size("v").alias("width"))


@query("pf22_concat_text", "select page_id, url || ' ' || html as text from pages")
def _(t):
    return t.pages.select("page_id", F.concat_ws(" ", "url", "html").alias("text"))


@query("pf23_entity_cluster", "select doc_id, source, lang from documents where source = 'src1' and lang = 'en'")
def _(t):
    return cleanse.filter_entity_cluster(t.documents, "source", "src1", "lang", "en").select("doc_id", "source", "lang")


@query("pf24_threshold_predict", f"with {SCORED} select doc_id, p, case when p > 0.5 then 1 else 0 end as predicted from scored")
def _(t):
    return scored(t).select("doc_id", "p", C.threshold_predict(F.col("p"), 0.5).alias("predicted"))


@query("pf26_row_id", """select row_number() over (order by doc_id) as row_id, doc_id, lower(text) as text from documents""")
def _(t):
    return cleanse.number_texts(t.documents.select("doc_id", "text"), "text", "doc_id")


@query("j1_left_merge", """select c_custkey, coalesce(n, 0) as n, coalesce(total, 0) as total, coalesce(last_n, 0) as last_n
  from customer left join (select o_custkey as c_custkey, count(*) as n from orders where o_orderstatus = 'F' group by 1) using (c_custkey)
  left join (select o_custkey as c_custkey, round(sum(o_totalprice), 2) as total from orders where o_orderstatus = 'O' group by 1) using (c_custkey)
  left join (select o_custkey as c_custkey, count(*) as last_n from orders where o_orderpriority = '1-URGENT' group by 1) using (c_custkey)""")
def _(t):
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    by = lambda cond, e: o.filter(cond).groupBy("c_custkey").agg(e)
    return lookup.left_merge(t.customer.select("c_custkey"), [
        by(F.col("o_orderstatus") == "F", F.count(F.lit(1)).alias("n")),
        by(F.col("o_orderstatus") == "O", F.round(F.sum("o_totalprice"), 2).alias("total")),
        by(F.col("o_orderpriority") == "1-URGENT", F.count(F.lit(1)).alias("last_n"))], "c_custkey")


@query("j2_dimension_join", """select l_orderkey, l_linenumber, l_partkey, p_name, p_brand from lineitem left join part on l_partkey = p_partkey""")
def _(t):
    items = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return lookup.dimension_join(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), items, "l_partkey")


@query("j3_align_divide", f"""with {LOANS} select nation, round(nullif(count(*) filter ({STATUS_SQL} = 1), 0)::double
  / nullif(count(*) filter ({STATUS_SQL} = 0), 0), 6) as ratio from loans group by nation""")
def _(t):
    y = C.map_values(F.col("loan_status"), STATUS)
    return (lookup.align_divide(loans(t), "nation", y == 1, y == 0)
            .select("nation", F.round("ratio", 6).alias("ratio")))


@query("j4_dict_lookup", f"""with {HOUSE}, fit as (select brand, round(avg(price), 4) as mean_price from house
  where not {is_test_sql('sale_id')} and brand <> 'Brand#12' group by brand)
  select sale_id, line, brand, mean_price from house left join fit using (brand) where {is_test_sql('sale_id')}""")
def _(t):
    h = house(t)
    fit = (h.filter(~is_test("sale_id") & (F.col("brand") != "Brand#12")).groupBy("brand")
           .agg(F.round(F.avg("price"), 4).alias("mean_price")))
    return lookup.lookup(h.filter(is_test("sale_id")).select("sale_id", "line", "brand"), fit, "brand")


@query("j6_shared_users", f"""with {TRANSACTIONS}, m as (select "user", item, avg(quantity) as q from transactions group by 1, 2)
  select b.item as other, count(*) as users, round(sum(a.q * b.q), 4) as dot
  from m a join m b on a."user" = b."user" where a.item = 7 group by 1""")
def _(t):
    from brambling.operators.recommend import shared_users
    return shared_users(transactions(t), 7).select("other", "users", F.round("dot", 4).alias("dot"))


@query("j7_labels_by_key", f"with {CLUSTERED} select vec_id, label, cluster from clustered")
def _(t):
    # the cluster travels with its key; nothing is glued together by row position
    c = clustered(t)
    return t.embeddings.select("vec_id", "label").join(c.select("vec_id", "cluster"), "vec_id")
