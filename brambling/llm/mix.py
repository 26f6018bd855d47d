"""Mixing overlapping sources to target weights by min-cost flow.

Documents are counted by membership pattern (the set of sources they belong to).  A small network
routes the words of each pattern to the quotas of its sources: a pattern may be used once for free
and again at a growing cost, so repetition is spent evenly and only where a quota needs it.  The flow
says how often each pattern is used; whole rounds take every document, the rest is filled with
documents in a seeded order.

Only one row per pattern reaches the driver.  Positions in the seeded order are running sums over
sorted blocks, so a pattern with most of the rows is spread over all tasks.

Defined cases: a null text has size 0 and takes nothing; a null source is a source of its own, last
in order; a document without any source takes nothing; equal rows (same id and
text) are taken or left together; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections import deque

from pyspark.sql import Column, DataFrame, functions as F

from brambling.llm.common import col, n_words, settle
from brambling.operators.ordering import running_sums

WEIGHTS = (5, 2, 1)
REPEATS = 3


def source_order(sources: list[str | None]) -> list[str | None]:
    """By code point, null last."""
    return sorted((s for s in sources if s is not None)) + [None] * (None in sources)


def targets(sizes: dict[str | None, int], total: int, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> dict[str | None, float]:
    """Share ``total`` words by weight; no target above ``repeats`` times its source."""
    order = source_order(list(sizes))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, active, out = float(total), list(order), {}
    while active:
        whole = sum(weight[s] for s in active)
        full = [s for s in active if left * weight[s] / whole > repeats * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / whole for s in active}
        for s in full:
            out[s] = float(repeats * sizes[s])
        left -= sum(out[s] for s in full)
        active = [s for s in active if s not in out]
    return out


def min_cost_flow(n: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow of each (from, to, capacity, cost) arc in a cheapest greatest flow, by shortest augmenting paths."""
    to, room, cost, out = [], [], [], [[] for _ in range(n)]
    for a, b, c, w in arcs:
        for x, y, r, k in ((a, b, c, w), (b, a, 0, -w)):
            out[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(k)
    while True:
        dist, via, queued, queue = {source: 0}, {}, {source}, deque([source])
        while queue:
            x = queue.popleft()
            queued.discard(x)
            for e in out[x]:
                if room[e] and dist[x] + cost[e] < dist.get(to[e], 1 << 62):
                    dist[to[e]], via[to[e]] = dist[x] + cost[e], e
                    if to[e] not in queued:
                        queued.add(to[e])
                        queue.append(to[e])
        if sink not in dist:
            return [c - room[2 * i] for i, (_, _, c, _) in enumerate(arcs)]
        path, at = [], sink
        while at != source:
            path.append(via[at])
            at = to[via[at] ^ 1]
        n_units = min(room[e] for e in path)
        for e in path:
            room[e] -= n_units
            room[e ^ 1] += n_units


def route(patterns: dict[tuple, int], quota: dict[str | None, float], repeats: int = REPEATS) -> dict[tuple, int]:
    """Words to take from each pattern (repeats counted) so that the sources come to their quotas."""
    names, sources = list(patterns), source_order(list(quota))
    node = {s: 2 + len(names) + i for i, s in enumerate(sources)}
    arcs = []
    for i, p in enumerate(names):
        for r in range(repeats):   # convex: the r-th repetition costs more than the one before
            arcs.append((0, 2 + i, patterns[p], r * (r + 1) // 2))
        arcs += [(2 + i, node[s], repeats * patterns[p], 0) for s in p]
    arcs += [(node[s], 1, round(quota[s]), 0) for s in sources]
    flow = min_cost_flow(2 + len(names) + len(sources), arcs, 0, 1)
    taken = dict.fromkeys(names, 0)
    for (a, b, _, _), f in zip(arcs, flow):
        if a == 0:
            taken[names[b - 2]] += f
    return taken


def mix(docs: DataFrame, members: Column, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = 11,
        id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, size, members, source_size, target, copies, taken) for every row of ``docs``.

    ``members`` is the array of sources a document belongs to; ``row`` is the input row as a struct.
    ``source_size`` and ``target`` are those of the first source in order.  ``copies`` is how often
    the mix holds the document, 0 to ``repeats``; ``taken`` is ``copies`` times its size.
    """
    spark = docs.sparkSession
    # null sorts last, as in the order of sources
    given = docs.select(
        F.struct("*").alias("row"), col(id).alias("doc_id"), n_words(col(text)).alias("size"),
        F.to_json(F.struct(F.array_sort(F.array_distinct(members.cast("array<string>"))).alias("m"))).alias("pattern"),
        F.xxhash64(F.lit(seed), col(id)).alias("k1"), F.xxhash64(F.lit(seed), col(text)).alias("k2"))
    keyed = settle(given.groupBy("pattern", "k1", "k2").agg(F.sum("size").alias("size")))
    counted = {r.pattern: r.n for r in keyed.groupBy("pattern").agg(F.sum("size").alias("n")).collect()}   # a row per pattern
    sets = {p: tuple(json.loads(p).get("m") or ()) for p in counted}
    sizes: dict[str | None, int] = {}
    for p, n in counted.items():
        for s in sets[p]:
            sizes[s] = sizes.get(s, 0) + n
    quota = targets(sizes, sum(n for p, n in counted.items() if sets[p]), weights, repeats)   # shared documents count once
    taken = route({sets[p]: n for p, n in counted.items() if sets[p]}, quota, repeats)
    plan = []
    for p, n in counted.items():
        use, first = taken.get(sets[p], 0), (source_order(list(sets[p])) or [None])[0]
        known = bool(sets[p])
        plan.append((p, use // n if n else 0, use % n if n else 0, sizes[first] if known else 0, quota[first] if known else 0.0))
    rounds = spark.createDataFrame(plan, "pattern string, whole long, rest long, source_size long, target double")
    # a broken round ends with the last document of which more than half is needed
    upto = running_sums(keyed, ["k1", "k2"], {"upto": F.col("size")}, ["pattern"])
    ends = (upto.join(rounds, "pattern").filter(2 * F.col("upto") - F.col("size") < 2 * F.col("rest"))
            .groupBy("pattern").agg(F.max(F.struct("k1", "k2")).alias("last")))
    decided = settle(rounds.join(ends, "pattern", "left"))      # its size decides how it is joined
    more = F.coalesce(F.struct("k1", "k2") <= F.col("last"), F.lit(False)).cast("long")
    met = given.join(decided, "pattern", "left")
    chosen = met.withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + more).otherwise(0))
    return chosen.select("row", "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, members: Column, **options) -> DataFrame:
    """The rows of ``docs`` as the mix holds them: repeated, once, or not at all."""
    chosen = mix(docs, members, **options).filter(F.col("copies") > 0)
    return chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
