"""URL filters by link-graph propagation, from DataFrame operations alone.

Hosts are nodes; a page's absolute links are edges to other hosts.  Two personalised PageRanks run over the
same edges: trust flows forward from hosts whose urls an allow rule matches, distrust flows backward from
hosts whose urls a block rule matches (a host that links to blocked hosts is suspect).  Urls are those of the
pages and, each once, those that they link to, so a host without a page of its own can be a seed too.  A host is
blocked when its distrust outweighs its trust and exceeds a share of the mean; a rule that matches the url
decides before that.  Nothing flows between hosts for sharing a domain.

Edges are counted per pair of hosts first.  A host with very many neighbours is split: its edges are dealt
to parts by their other end, and its rank is repeated once per part, so no task holds all of them.

Defined cases: a null url, or one without ``://``, has an empty host and path and is allowed; an empty host is
no node; null html has no links; links back to the own host count for nothing; hosts without edges keep only
what they start with; repeated pages count as often as they appear; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brambling.llm.common import col, settle

#: (pattern, verdict); a pattern is a host, then a path from its first slash on.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
DAMPING, ROUNDS = 0.85, 12
FACTOR, FLOOR = 1.0, 0.1     # block if distrust > FACTOR * trust and distrust > FLOOR / hosts
PART = 10_000                # neighbours of a host in one part
WRITE_EVERY = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to /, ?, # or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule whose host is the url's or above it and whose path begins the url's; null if none."""
    out = None
    for pattern, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        at, _, rest = pattern.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(pattern)) if out is None else out.when(fits, F.lit(pattern))
    return out if out is not None else F.lit(None).cast("string")


def rule_verdict(rule: Column, rules=RULES) -> Column:
    known = [(p, v) for p, v in rules]
    return F.coalesce(*[F.when(rule == p, F.lit(v)) for p, v in known], F.lit(None).cast("string"))


LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, to): the absolute links of every page, and the host they are on."""
    found = F.regexp_extract_all(F.coalesce(col(html), F.lit("")), F.lit(LINK), F.lit(1))
    linked = pages.select(host_of(col(url)).alias("a"), F.explode(found).alias("to"))
    return linked.withColumn("to", F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), F.col("to"))).otherwise(F.col("to")))


def link_edges(linked: DataFrame) -> DataFrame:
    """(a, b, w): how often pages of host a link to host b."""
    return (linked.select("a", host_of(F.col("to")).alias("b")).filter((F.col("a") != "") & (F.col("b") != "") & (F.col("a") != F.col("b")))
            .groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("w")))


def _parted(edges: DataFrame, source: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Edges with their share of the source's weight and a part, and the number of parts of each source."""
    out = edges.groupBy(source).agg(F.sum("w").alias("all"), F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")).withColumnRenamed(source, "x")
    met = edges.select(F.col(source).alias("x"), F.col(target).alias("y"), "w").join(out, "x")
    return met.select("x", F.pmod(F.xxhash64("y"), F.col("parts")).cast("int").alias("part"), "y", (F.col("w") / F.col("all")).alias("share")), out.select("x", "parts")


def personalised_rank(nodes: DataFrame, edges: DataFrame, seed: str, source: str = "a", target: str = "b",
                      damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, rank) after ``rounds`` steps, summing to 1; ``nodes`` hold the start weights in ``seed``.

    What reaches a host without edges in this direction would return to the seeds; that only scales all
    ranks alike, so it is left out of the steps and made up for by the division at the end.
    """
    parted, parts = _parted(edges, source, target)
    parted = settle(parted)
    total = nodes.agg(F.sum(seed)).first()[0] or 1.0
    start = settle(nodes.join(parts.withColumnRenamed("x", "host"), "host", "left").select("host", (F.col(seed) / total).alias("jump"), "parts"))
    ranks = start.withColumn("rank", F.col("jump"))
    for k in range(1, rounds + 1):
        sent = (ranks.filter(F.col("parts").isNotNull() & (F.col("rank") > 0))
                .select(F.col("host").alias("x"), "rank", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
        got = sent.join(parted, ["x", "part"]).groupBy(F.col("y").alias("host")).agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
        ranks = start.join(got, "host", "left").withColumn("rank", (1 - damping) * F.col("jump") + damping * F.coalesce("got", F.lit(0.0))).drop("got")
        if k % WRITE_EVERY == 0 or k == rounds:
            ranks = settle(ranks)
    whole = ranks.agg(F.sum("rank")).first()[0] or 1.0
    return ranks.select("host", (F.col("rank") / whole).alias("rank"))


def judge_hosts(seeds: DataFrame, edges: DataFrame, factor: float = FACTOR, floor: float = FLOOR) -> DataFrame:
    """(host, trust, distrust, blocked) of every node; ``seeds`` are (host, good, bad), each host once."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("host")).distinct()
    nodes = settle(ends.union(seeds.select("host")).distinct().join(seeds, "host", "left").fillna(0.0, ["good", "bad"]))
    trust = personalised_rank(nodes, edges, "good").withColumnRenamed("rank", "trust")
    distrust = personalised_rank(nodes, edges, "bad", "b", "a").withColumnRenamed("rank", "distrust")
    least = floor / max(nodes.count(), 1)
    bad = (F.col("distrust") > factor * F.col("trust")) & (F.col("distrust") > least)
    return trust.join(distrust, "host").select("host", "trust", "distrust", bad.alias("blocked"))


def judge(pages: DataFrame, rules=RULES, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) for every row of ``pages``."""
    seen = pages.select(col(id).alias("page_id"), host_of(col(url)).alias("host"), path_of(col(url)).alias("path"))
    by_rule = lambda df: df.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("by_rule", rule_verdict(F.col("rule"), rules))
    ruled, linked = by_rule(seen), settle(links(pages, url, html))
    targets = by_rule(linked.select("to").distinct().select(host_of(F.col("to")).alias("host"), path_of(F.col("to")).alias("path")))
    hit = lambda v: F.sum((F.coalesce(F.col("by_rule"), F.lit("")) == v).cast("double"))
    urls = ruled.select("host", "by_rule").union(targets.select("host", "by_rule"))
    seeds = settle(urls.filter(F.col("host") != "").groupBy("host").agg(hit("allow").alias("good"), hit("block").alias("bad")))
    edges = settle(link_edges(linked))
    hosts = judge_hosts(seeds, edges)
    met = ruled.join(hosts, "host", "left")
    verdict = F.coalesce("by_rule", F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow")))
    return met.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
