"""Sources and sinks: what is written is read back and must be the same rows."""

from pyspark.sql import functions as F

from brambling.catalog.registry import query
from brambling.session import new_path
from brambling.sources import pages, reviews, tables


@query("io1_read_csv", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders")
def _(t):
    path = new_path(t.spark, "csv")
    tables.write_csv(t.orders, path)
    return tables.read_csv(t.spark, path, t.orders.schema)


@query("io2_read_csv_uri", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def _(t):
    path = new_path(t.spark, "csv")
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    tables.write_csv(t.customer, uri)
    return tables.read_csv(t.spark, uri, t.customer.schema)


@query("io3_write_csv", "select p_brand, count(*) as n, round(sum(p_retailprice), 2) as total from part group by 1")
def _(t):
    path = new_path(t.spark, "csv")
    tables.write_csv(t.part, path)
    back = tables.read_csv(t.spark, path, t.part.schema)
    return back.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("p_retailprice"), 2).alias("total"))


@query("io4_write_json", "select conv_id, turn, role, text from conversations")
def _(t):
    path = new_path(t.spark, "json")
    tables.write_json(t.conversations, path, partition_by="role")
    return t.spark.read.schema(t.conversations.schema).json(path)


@query("io5_read_json_dir", "select source as accommodation_id, text as pros, lang as cons, text || '. ' || lang as review from documents")
def _(t):
    path = new_path(t.spark, "reviews")
    payload = F.to_json(F.struct(F.array(F.struct(F.col("text").alias("pros"), F.col("lang").alias("cons"))).alias("result")))
    tables.write_json(t.documents.select("lang", F.col("source").alias("accommodation_id"), payload.alias("reviews")), path, "lang")
    return reviews.explode_reviews(reviews.read_json_dir(t.spark, path))


@query("io5_event_props", """select event_id, (props->>'$.k')::bigint as k from events""")
def _(t):
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("io6_entity_summary", """select s_suppkey as hotel_id, s_name as hotel_name, (s_suppkey % 100) as review_nr, n_name as zipcode, 'u/' || s_suppkey as url, null as max_photo_url
  from supplier join nation on s_nationkey = n_nationkey""")
def _(t):
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    entity = F.struct(F.col("s_suppkey").alias("hotel_id"), F.col("s_name").alias("hotel_name"), (F.col("s_suppkey") % 100).alias("review_nr"),
                      F.col("n_name").alias("zip"), F.concat(F.lit("u/"), F.col("s_suppkey")).alias("url"),
                      F.lit(None).cast("string").alias("max_photo_url"))
    return reviews.entity_summary(s.select(F.array(entity).alias("result")))


@query("io11_html_fields", r"""select page_id, nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') as name, nullif(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '') as heading,
  nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') as language from pages""")
def _(t):
    return pages.html_fields(t.pages, "page_id", "html")


@query("io11_html_links", r"""select page_id, unnest(range(len(l)))::int as position, unnest(l) as url from (select page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) as l from pages)""")
def _(t):
    return pages.html_list(t.pages, "page_id", "html")


@query("io12_append_results", "select event_id, event_type, value from events")
def _(t):
    path = new_path(t.spark, "log")
    e = t.events.select("event_id", "event_type", "value", "ts")
    noon = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    for part in (e.filter(F.col("ts") < noon), e.filter(F.col("ts") >= noon)):
        tables.append_results(part.drop("ts"), path)
    return t.spark.read.parquet(path)
