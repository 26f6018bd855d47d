"""The registered queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brambling.llm import crosspoly, fourrussians, hostrank, jaccard, langid, lexical, mix, omh, pack, pii, rules, shard, template
from brambling.llm.common import table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the DuckDB statement for its rows where SQL can express them."""
    def wrap(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return wrap


TRICKY = "\\### Assistant: </turn> ok"
_WRITTEN = "length({0}) + length(regexp_replace({0}, '[^\\\\#<:]', '', 'g'))"     # an escaped character takes two
CHAT_SQL = f"""with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select * from (values (-7, 0, 'user', '{TRICKY}'), (-7, 1, 'assistant', '{TRICKY}')))
  select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
    sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
    sum(14 + {_WRITTEN.format('role')} + {_WRITTEN.format('text')})::bigint as formatted_chars from c group by conv_id"""

#: All pairs that share an n-gram, then everything that links reach.
JACCARD_SQL = r"""with recursive w as (select doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as l from documents),
  g as materialized (select distinct doc_id, unnest(list_transform(range(1, greatest(len(l) - 3, 2)), lambda i: array_to_string(l[i:i + 4], ' '))) as s from w where len(l) > 0),
  n as materialized (select doc_id, count(*) as n from g group by 1),
  o as (select a.doc_id as a, b.doc_id as b, count(*) as k from g a join g b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
  e as materialized (select a, b from o join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 75 * (na.n + nb.n - k)),
  r as (select doc_id as a, doc_id as b from documents union select r.a, e.b from r join e on r.b = e.a)
  select doc_id, coalesce(n.n, 0) as n_shingles, c.b as component_id from documents left join n using (doc_id) join (select a as doc_id, min(b) as b from r group by 1) c using (doc_id)"""

#: All pairs of usable vectors, then everything that links reach.
VECTOR_SQL = """with recursive v as materialized (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings),
  u as materialized (select * from v where len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
  l as materialized (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95),
  r as (select vec_id as a, vec_id as b from v union select r.a, l.b from r join l on r.b = l.a)
  select vec_id, (select count(*) from l where a = vec_id) as n_links, c.b as component_id, vec_id = c.b as kept from v join (select a, min(b) as b from r group by 1) c on a = vec_id"""

#: Counts of the items' terms in every text, scored and ranked in 64-bit integers.
LEXICAL_SQL = r"""with t as materialized (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
  d as materialized (select doc_id, count(*) as n from t group by 1), s as (select count(*) as N, sum(n)::bigint as L from d),
  q as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
  f as materialized (select doc_id, term, count(*) as tf from t where term in (select term from q) group by 1, 2),
  w as (select term, floor(1000 * ln((2.0::double * (select N from s) + 2) / (2 * count(*) + 1)))::bigint as w from f group by 1),
  g as (select q.item_id, f.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * (select N from s)) // (select L from s)))))::bigint as score
    from q join f using (term) join w using (term) join d using (doc_id) group by 1, 2)
  select item_id, rank::int as rank, doc_id, score from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from g where score > 0) where rank <= 10"""

#: All scores of anchors with all rows.
NEGATIVES_SQL = """with v as materialized (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  s as materialized (select a.vec_id as anchor_id, a.label as own, b.vec_id, b.label, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score from v a, v b where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
  p as (select anchor_id, vec_id as positive_id, score as positive_score from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as k from s where label = own) where k <= 5),
  n as (select anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as k
    from p join s using (anchor_id) where label <> own and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
  select anchor_id, positive_id, k::int as rank, negative_id, positive_score, negative_score from n where k <= 5"""


def _host_sql() -> str:
    """Both ranks, unrolled over their rounds."""
    from_url = lambda u: (f"translate(coalesce(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, "
                          f"coalesce(regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path")
    order = sorted(hostrank.RULES, key=lambda r: (-len(r[0]), r[0]))
    fits = lambda at, rest: f"(host = '{at}' or ends_with(host, '.{at}')) and starts_with(path, '/{rest}')"
    case = "case " + " ".join(f"when {fits(p.partition('/')[0], p.partition('/')[2])} then '{p}'" for p, _ in order) + " end"
    said = "case rule " + " ".join(f"when '{p}' then '{v}'" for p, v in hostrank.RULES) + " end"
    link = hostrank.LINK.replace("'", "''")
    d = hostrank.DAMPING
    parts = [f"""p as materialized (select *, {case} as rule from (select page_id, html, {from_url('url')} from pages))""",
             f"""k as materialized (select host as a, unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)) as t from p)""",
             f"""u as materialized (select *, {case} as rule from (select t, {from_url('t')} from (select distinct case when starts_with(t, '//') then 'http:' || t else t end as t from k)))""",
             """e as materialized (select a, host as b, count(*)::double as w from k join u on u.t = case when starts_with(k.t, '//') then 'http:' || k.t else k.t end where a <> '' and host <> '' and a <> host group by 1, 2)""",
             f"""s as (select host, count(*) filter (where v = 'allow')::double as good, count(*) filter (where v = 'block')::double as bad from (select host, {said} as v from p union all select host, {said} from u) where host <> '' group by 1)""",
             """n as materialized (select host, coalesce(good / nullif((select sum(good) from s), 0), 0) as good, coalesce(bad / nullif((select sum(bad) from s), 0), 0) as bad from (select host from s union select a from e union select b from e) left join s using (host))"""]
    for name, seed, at, to in (("t", "good", "a", "b"), ("d", "bad", "b", "a")):
        parts += [f"{name}e as materialized (select {at} as x, {to} as y, w / sum(w) over (partition by {at}) as share from e)", f"{name}0 as (select host, {seed} as r from n)"]
        parts += [f"{name}{i} as materialized (select n.host, {1 - d} * {seed} + {d} * coalesce(g, 0) as r from n left join (select y, sum(r * share) as g from {name}{i - 1} join {name}e on x = host group by 1) on y = n.host)"
                  for i in range(1, hostrank.ROUNDS + 1)]
        parts.append(f"{name} as materialized (select host, r / coalesce(nullif((select sum(r) from {name}{hostrank.ROUNDS}), 0), 1) as r from {name}{hostrank.ROUNDS})")
    return "with " + ",\n  ".join(parts) + f"""
  select page_id, p.host, path, rule, coalesce({said}, case when d.r > {hostrank.FACTOR} * t.r and d.r > {hostrank.FLOOR} / greatest((select count(*) from n), 1) then 'block' else 'allow' end) as verdict,
    round(t.r, 9) + 0.0::double as trust, round(d.r, 9) + 0.0::double as distrust from p left join t on t.host = p.host left join d on d.host = p.host"""


@query("op1_ecoc_language")
def op1(spark, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    model = langid.fit(docs, langid.fold(F.col("doc_id")) == 0)
    said = langid.identify(docs, model)
    return said.select("doc_id", (langid.fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "runner_up", "ambiguous")


@query("op2_host_rank", _host_sql())
def op2(spark, root: str) -> DataFrame:
    judged = hostrank.judge(table(spark, root, "pages"))
    return judged.withColumns({c: F.round(c, 9) + 0.0 for c in ("trust", "distrust")})


@query("op3_decision_list")
def op3(spark, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    found = rules.fit(docs, table(spark, root, "labels"))
    return rules.judge(docs.select("doc_id", "text"), found).select("row.doc_id", *rules.STATISTICS, "base_failed", "rule", "kept")


@query("op4_chat_template", CHAT_SQL)
def op4(spark, root: str) -> DataFrame:
    added = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    talks = table(spark, root, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return template.read_back(template.render(talks))


@query("op5_fragment_join", JACCARD_SQL)
def op5(spark, root: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, root, "documents"))


@query("op6_order_minhash")
def op6(spark, root: str) -> DataFrame:
    return omh.compare(table(spark, root, "documents"))


@query("op7_char_crf")
def op7(spark, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("row.doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


@query("op8_ring_shards")
def op8(spark, root: str) -> DataFrame:
    out = shard.assign(table(spark, root, "documents"), 8, law="rows")
    return out.withColumn("grown_shard", F.lit(None).cast("int"))


@query("op9_flow_mix")
def op9(spark, root: str) -> DataFrame:
    mixed = mix.mix(table(spark, root, "documents"), F.array("source"))
    return mixed.select("doc_id", "size", "source_size", "target", "copies", "taken")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file, read on the driver and sent to the tasks."""
    import public_tokenizers
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@query("op10_binary_packing")
def op10(spark, root: str) -> DataFrame:
    """The sequences are written with their ids; what comes out is their digest."""
    pieces = pack.decompose(table(spark, root, "documents"), vocabulary())
    return pack.digest(pack.pack(pieces))


@query("op11_cross_polytope", VECTOR_SQL)
def op11(spark, root: str) -> DataFrame:
    return crosspoly.near_vectors(table(spark, root, "embeddings"))


@query("op12_automaton_search", LEXICAL_SQL)
def op12(spark, root: str) -> DataFrame:
    return lexical.search(table(spark, root, "documents"), table(spark, root, "benchmark"))


@query("op13_four_russians", NEGATIVES_SQL)
def op13(spark, root: str) -> DataFrame:
    vectors = table(spark, root, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return fourrussians.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)
