"""Inputs derived from the given tables, and the same derivations as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brambling.functions import columns as C
from brambling.sources.tables import Tables, spread


def house(t: Tables) -> DataFrame:
    """Sales: one row per line item with the attributes of its part."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_shipdate")
    return (spread(lines).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").alias("sale_id"), F.col("l_linenumber").alias("line"),
                    F.col("l_extendedprice").alias("price"), F.col("p_brand").alias("brand"),
                    F.col("p_type").alias("kind"), F.col("l_quantity").alias("quantity"),
                    F.col("p_size").alias("size"), F.col("p_retailprice").alias("retail"),
                    F.col("l_shipdate").alias("sold_at")))


HOUSE = """house as (select l_orderkey as sale_id, l_linenumber as line, l_extendedprice as price, p_brand as brand,
  p_type as kind, l_quantity as quantity, p_size as size, p_retailprice as retail, l_shipdate as sold_at
  from lineitem join part on l_partkey = p_partkey)"""


def loans(t: Tables) -> DataFrame:
    """Loans: one row per order with the attributes of its customer; some amounts are missing."""
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").alias("loan_id"), F.col("o_orderstatus").alias("loan_status"),
                    F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_totalprice")).alias("amount"),
                    F.when(F.col("o_orderkey") % 5 == 0, None).otherwise(F.col("c_acctbal")).alias("balance"),
                    F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"),
                    F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("issued")))


LOANS = """loans as (select o_orderkey as loan_id, o_orderstatus as loan_status,
  case when o_orderkey % 7 = 0 then null else o_totalprice end as amount,
  case when o_orderkey % 5 = 0 then null else c_acctbal end as balance,
  c_mktsegment as segment, c_nationkey as nation, o_orderpriority as priority, o_orderdate as issued
  from orders join customer on o_custkey = c_custkey)"""

STATUS = {"F": 0, "O": 1}
STATUS_SQL = "case trim(loan_status) when 'F' then 0 when 'O' then 1 end"


def is_test(column: str):
    return C.hash_bucket(F.col(column)) < 20


def is_test_sql(column: str) -> str:
    return f"(('0x' || substr(md5(cast({column} as varchar) || '|42'), 1, 8))::BIGINT % 100 < 20)"


def bars(t: Tables) -> DataFrame:
    """Hourly bars: one symbol per event type."""
    at = F.struct("ts", "event_id")
    return (t.events.groupBy(F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("open_time"))
            .agg(F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"),
                 F.max_by("value", at).alias("price"), F.count(F.lit(1)).cast("double").alias("volume"))
            .withColumn("open_time", F.col("open_time").cast("timestamp_ntz")))


BARS = """bars as (select event_type as symbol, date_trunc('hour', ts)::timestamp as open_time,
  arg_min(value, ts) as open, max(value) as high, min(value) as low, arg_max(value, ts) as price,
  count(*)::double as volume from events group by 1, 2)"""


def daily(t: Tables) -> DataFrame:
    """Daily close: the last value of each event type and day."""
    return (t.events.groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"))
            .agg(F.max_by("value", F.struct("ts", "event_id")).alias("close")))


DAILY = """daily as (select event_type as symbol, ts::date as date, arg_max(value, ts) as close
  from events group by 1, 2)"""


def transactions(t: Tables) -> DataFrame:
    return (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"), F.col("l_quantity").alias("quantity")))


TRANSACTIONS = """transactions as (select o_custkey as "user", l_partkey as item, l_quantity as quantity
  from lineitem join orders on l_orderkey = o_orderkey)"""


def scored(t: Tables) -> DataFrame:
    """Binary outcome with a score in (0, 1) rounded so that ties occur."""
    return (t.labels.join(t.documents, "doc_id")
            .select("doc_id", F.col("quality").alias("y"),
                    F.round(1 / (1 + F.exp(-(F.col("n_chars") - 1500) / 1000.0)), 2).alias("p")))


SCORED = """scored as (select doc_id, quality as y, round(1 / (1 + exp(-(n_chars - 1500) / 1000.0)), 2) as p
  from labels join documents using (doc_id))"""


def clustered(t: Tables) -> DataFrame:
    """Vectors with a label and a cluster read off the signs of two components."""
    e = F.col("embedding")
    return t.embeddings.select(
        "vec_id", "label", "embedding",
        (F.when(e[0] > 0, 1).otherwise(0) + F.when(e[1] > 0, 2).otherwise(0)).alias("cluster"))


CLUSTERED = """clustered as (select vec_id, label, embedding,
  case when embedding[1] > 0 then 1 else 0 end + case when embedding[2] > 0 then 2 else 0 end as cluster
  from embeddings)"""
