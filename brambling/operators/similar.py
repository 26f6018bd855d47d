"""The most similar items of every item, exact and without listing all pairs.

Items are sets of (user, weight).  Two measures are served: the cosine of mean quantities and the share of common users
(Jaccard).

An item whose users hold few items together (``LIGHT``) meets all of them: every user's list is packed once and sent
whole to each such item, whose partners are added up in one task; only its best leave the task, so no pair becomes a
row.  This goes in rounds, a share of the items in each, so that what lies on disk at once stays near the entries
themselves (``ROUND``, ``KEPT``).  Items that meet more are searched by bounded prefixes:

1. *Floor.*  A few promising partners of each item (those that its heaviest users hold most of) are compared in full;
   the k-th best similarity is a floor below which no partner counts.  This only guides the search.
2. *Prefix.*  An item's users are put in order, rare ones first.  Every user takes a part of the item's mass (squared
   weight, or share of users).  A partner at or above the floor shares one of the first users, up to the point where
   the mass left is too small to reach the floor alone; so only those users' rows are met, and crowded users, at the end
   of the order, are met by few items.
3. *Bound.*  What the prefix adds up to, plus the most that the rest of the mass could add, bounds each candidate from
   above; those below the floor go.
4. *Rest.*  The remaining users of the surviving pairs are added, and the k best of each item are kept.

Items without a partner have no rows; ties go to the smaller item; null items, users and quantities are left out.
"""

from __future__ import annotations

import math
import struct
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from brambling.operators.ordering import running_sums, top_k_per_group
from brambling.operators.recommend import item_user
from brambling.session import new_path, settings, settle

SEED_USERS, SEED_ITEMS = 6, 30      # rows met for the floor: users of an item, and items of each of them
SLACK = 1e-8                        # a similarity is decided by its exact value, not by rounding in a bound
DIGITS = 9
LIGHT, LIST = 100_000, 20_000       # rows that an item may meet to be summed in one task, and the longest packed list
PAIRS, SENT = 4_000_000, 16_000_000 # rows met by a task, and bytes sent in one batch
ROUND, KEPT = 1_000_000_000, 48     # bytes of lists sent in a round, or so many for each entry if that is more


def _cosine_entries(transactions: DataFrame) -> DataFrame:
    """(item, user, w, mass, n): weights of length one."""
    m = item_user(transactions.na.drop(subset=["item", "user", "quantity"])).filter(F.col("q") != 0)
    norms = m.groupBy("item").agg(F.sqrt(F.sum(F.col("q") * F.col("q"))).alias("norm"), F.count(F.lit(1)).alias("n"))
    w = F.col("q") / F.col("norm")
    return m.join(norms, "item").select("item", "user", w.alias("w"), (w * w).alias("mass"), "n")


def _jaccard_entries(transactions: DataFrame) -> DataFrame:
    """(item, user, w, mass, n): every user weighs the same."""
    pairs = transactions.na.drop(subset=["item", "user"]).select("item", "user").distinct()
    sizes = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return pairs.join(sizes, "item").select("item", "user", F.lit(1.0).alias("w"), (1 / F.col("n")).alias("mass"), "n")


class _Measure:
    """How sums of products become a similarity, and how much of it a part of the mass can give at most."""

    def __init__(self, cosine: bool):
        self.cosine = cosine

    def score(self, dot: Column, n: Column, n0: Column) -> Column:
        return dot if self.cosine else dot / (n + n0 - dot)

    def most(self, mass: Column) -> Column:
        """The greatest similarity that ``mass`` of an item can reach alone."""
        left = F.greatest(mass, F.lit(0.0))
        return F.sqrt(left) if self.cosine else left

    def bound(self, dot: Column, left: Column, n0: Column) -> Column:
        """The greatest similarity of a pair whose first users add up to ``dot``; ``left`` is the mass of the others."""
        return dot + self.most(left) if self.cosine else dot / n0 + left


def _floors(entries: DataFrame, own: DataFrame, measure: _Measure, k: int) -> DataFrame:
    """(seed, floor): the k-th best similarity among a few promising partners, 0 if they are fewer."""
    users = top_k_per_group(own.select("item", "user", "w"), ["item"], [F.desc("w"), "user"], SEED_USERS, "r").select(F.col("item").alias("seed"), "user")
    items = top_k_per_group(entries.select("user", "item", "w"), ["user"], [F.desc("w"), "item"], SEED_ITEMS, "r").select("user", "item")
    pairs = users.join(items, "user").filter(F.col("seed") != F.col("item")).select("seed", "item").distinct()
    scored = _summed(settle(pairs), own, entries, measure)
    kth = top_k_per_group(scored.select("seed", "item", "similarity"), ["seed"], [F.desc("similarity"), "item"], k, "r")
    return kth.groupBy("seed").agg(F.when(F.count(F.lit(1)) >= k, F.min("similarity")).otherwise(0.0).alias("floor"))


def _summed(pairs: DataFrame, own: DataFrame, other: DataFrame, measure: _Measure, start: str | None = None) -> DataFrame:
    """(seed, item, users, dot, similarity) of the pairs, from the rows of ``own`` and ``other``; ``start`` names a struct to go on from."""
    mine = own.select(F.col("item").alias("seed"), "user", F.col("w").alias("w0"), F.col("n").alias("n0"))
    met = pairs.join(mine, "seed").join(other.select("item", "user", "w", "n"), ["item", "user"])
    sums = met.groupBy("seed", "item").agg(F.count(F.lit(1)).alias("users"), F.sum(F.col("w0") * F.col("w")).alias("dot"), F.first("n").alias("n"), F.first("n0").alias("n0"))
    return sums.withColumn("similarity", measure.score(F.col("dot"), F.col("n"), F.col("n0")))


WIDTHS, HEAD = {2: "<u2", 4: "<u4", 8: "<i8"}, struct.Struct("<Bq")


def _packed_list(items: np.ndarray, values: np.ndarray) -> bytes:
    """The first of ascending items, the steps from there in the least width that holds them, then their values."""
    steps = np.diff(items, prepend=items[:1])
    width = 8 if steps.min() < 0 else next((w for w in (2, 4) if steps.max() < 1 << 8 * w), 8)
    return HEAD.pack(width, items[0]) + steps.astype(WIDTHS[width]).tobytes() + values.tobytes()


def _unpacked(blobs: list[bytes], sizes: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The items and values of many packed lists in a row."""
    firsts, items, values = [], [], []
    for blob, n in zip(blobs, sizes.tolist()):
        width, first = HEAD.unpack_from(blob)
        firsts.append(first)
        items.append(np.frombuffer(blob, WIDTHS[width], n, HEAD.size).cumsum(dtype=np.int64))
        values.append(np.frombuffer(blob, kind, n, HEAD.size + width * n))
    return np.concatenate(items) + np.repeat(np.array(firsts, np.int64), sizes), np.concatenate(values)


def _nth(group: np.ndarray) -> np.ndarray:
    """The place of each row in its run of equal values, from 0."""
    at = np.arange(len(group))
    return at - np.maximum.accumulate(np.where(np.diff(group, prepend=group[:1] - 1) != 0, at, 0))


def _light_best(marked: DataFrame, pairs: int, k: int, cosine: bool) -> DataFrame:
    """(seed, item, users, similarity): the best of every light item and what ties with them within ``SLACK``."""
    spark, kind = marked.sparkSession, "<f8" if cosine else "<i4"
    cells = F.struct("item", (F.col("w") if cosine else F.col("n").cast("int")).alias("v"), "n", "w", "light")
    lists = (marked.filter(F.col("crowd") <= LIST).groupBy("user").agg(F.array_sort(F.collect_list(cells)).alias("c"))
             .filter(F.exists("c", lambda x: x["light"])).select(*[F.col(f"c.{f}").alias(f) for f in ("item", "v", "n", "w", "light")]))

    def pack(batches):
        """Each user's list as bytes, with the light items that it is sent to."""
        for b in batches:
            ends = b.column(0).offsets.to_numpy()
            ends = ends - ends[0]
            item, v, n, w, light = (b.column(i).flatten().to_numpy(zero_copy_only=False) for i in range(5))
            light = light.astype(bool)
            blobs = [_packed_list(item[lo:hi], v[lo:hi].astype(kind)) for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())]
            edges = np.append(0, np.cumsum(light))[ends].astype(np.int32)
            own = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x[light].astype(t))) for x, t in ((item, np.int64), (w, float), (n, np.int64))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(ends).astype(np.int32)), pa.array(blobs, pa.binary())], names=["seed", "w0", "n0", "size", "list"])

    held = settle(lists.mapInArrow(pack, "seed array<long>, w0 array<double>, n0 array<long>, size int, list binary"))
    sizes = held.agg(F.sum(F.size("seed") * F.length("list").cast("long")).alias("sent"), F.sum("size").alias("entries")).first()
    rounds = math.ceil((sizes["sent"] or 0) / max(ROUND, KEPT * (sizes["entries"] or 0))) or 1

    def sent(turn: int):
        def fn(batches):
            rows, held = [], 0

            def batch():
                seeds, w0, n0, sizes, blobs = zip(*rows)
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(seeds), pa.int64()), pa.array(np.concatenate(w0)), pa.array(np.concatenate(n0), pa.int64()),
                                                   pa.array(np.concatenate(sizes), pa.int32()), pa.array([b for some in blobs for b in some], pa.binary())], names=["seed", "w0", "n0", "size", "list"])

            for b in batches:
                ends = b.column(0).offsets.to_numpy()
                item, w, n = (b.column(i).flatten().to_numpy() for i in range(3))
                due = (item.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(rounds) == turn
                due, upto = np.flatnonzero(due), np.append(0, np.cumsum(due))[ends - ends[0]].tolist()
                for lo, hi, size, blob in zip(upto[:-1], upto[1:], b.column(3).to_pylist(), b.column(4).to_pylist()):
                    step = max(SENT // len(blob), 1)
                    for at in range(lo, hi, step):
                        some = due[at:min(at + step, hi)]
                        rows.append((item[some], w[some], n[some], np.full(len(some), size), [blob] * len(some)))
                        held += len(some) * len(blob)
                        if held >= SENT:
                            yield batch()
                            rows, held = [], 0
            if rows:
                yield batch()

        return fn

    def best(batches):
        seen = [b for b in batches if b.num_rows]
        if not seen:
            return
        table = pa.Table.from_batches(seen).combine_chunks()
        seed, w0, n0, sizes = (table.column(i).to_numpy() for i in range(4))
        order = np.lexsort((w0, seed))
        edges = np.flatnonzero(np.diff(seed[order], prepend=seed[order][0] - 1))
        met = np.add.reduceat(sizes[order].astype(np.int64), edges)
        parts = np.cumsum(met) // (PAIRS // 4)           # seeds of one part are added up together
        for part in np.unique(parts):
            mine = np.flatnonzero(parts == part)
            rows = order[edges[mine[0]]:(edges[mine[-1] + 1] if mine[-1] + 1 < len(edges) else len(order))]
            items, values = _unpacked(table.column(4).take(pa.array(rows)).to_pylist(), sizes[rows], kind)
            which = np.repeat(np.arange(len(rows)), sizes[rows])
            other = items != seed[rows][which]
            which, items, values = which[other], items[other], values[other]
            if not len(items):
                continue
            nth = np.cumsum(np.diff(seed[rows], prepend=seed[rows][0]) != 0)      # the number of the row's seed
            low, span = items.min(), float(items.max()) - float(items.min()) + 1
            short = span * (nth[-1] + 1) < 1 << 62
            by = np.argsort(nth[which] * int(span) + (items - low)) if short else np.lexsort((items, nth[which]))
            which, items, values = which[by], items[by], values[by]
            s = nth[which]
            starts = np.flatnonzero((np.diff(s, prepend=-1) != 0) | (np.diff(items, prepend=items[0] - 1) != 0))
            users = np.diff(np.append(starts, len(s)))
            if cosine:
                score = np.add.reduceat(values * w0[rows][which], starts)
            else:
                score = users / (values[starts] + n0[rows][which[starts]] - users)
            s, items = s[starts], items[starts]
            by = np.lexsort((items, -score, s))
            s, items, users, score = s[by], items[by], users[by], score[by]
            # equal scores are one run, of which the first k may count; the k-th best of the seed is the floor
            run = np.cumsum((np.diff(s, prepend=-1) != 0) | (np.diff(score, prepend=-1.0) != 0))
            place = _nth(s)
            floor = np.full(int(s[-1]) + 1, -np.inf)
            floor[s[place == k - 1]] = score[place == k - 1]
            keep = (_nth(run) < k) & (score >= floor[s] - SLACK)
            first = np.searchsorted(nth, s[keep])
            yield pa.RecordBatch.from_arrays([pa.array(seed[rows][first]), pa.array(items[keep]), pa.array(users[keep].astype(np.int64)), pa.array(score[keep])],
                                             names=["seed", "item", "users", "similarity"])

    tasks, path = max(math.ceil(pairs / rounds / PAIRS), spark.sparkContext.defaultParallelism), new_path(spark, "similar")
    schema = "seed long, item long, users long, similarity double"
    for turn in range(rounds):
        dealt = held.mapInArrow(sent(turn), "seed long, w0 double, n0 long, size int, list binary").repartition(tasks, "seed")
        dealt.mapInArrow(best, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def similar_items(transactions: DataFrame, k: int = 5, cosine: bool = True) -> DataFrame:
    """(seed, item, rank, users, similarity): the ``k`` items most like each item, and how many users the two share."""
    measure = _Measure(cosine)
    # what a step has shuffled is not needed once its table is written
    with settings(transactions.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        entries = settle(_cosine_entries(transactions) if cosine else _jaccard_entries(transactions))
        crowd = entries.groupBy("user").agg(F.count(F.lit(1)).alias("crowd"))
        crowded = settle(entries.join(crowd, "user"))
        whole = isinstance(entries.schema["item"].dataType, T.IntegralType)
        costs = crowded.groupBy("item").agg(F.sum("crowd").alias("cost"), (F.lit(whole) & (F.sum("crowd") <= LIGHT) & (F.max("crowd") <= LIST)).alias("light"))
        costs = settle(costs)
        marked = settle(crowded.join(costs.select("item", "light"), "item"))
        total = costs.agg(F.sum(F.when(F.col("light"), F.col("cost"))).alias("met"), F.count_if(~F.col("light")).alias("heavy")).first()
        found = [_light_best(marked, total["met"], k, cosine)] if total["met"] else []
        if total["heavy"] or not found:
            found.append(_heavy_scores(entries, marked.filter(~F.col("light")).drop("light"), measure, k))
    scored = reduce(DataFrame.unionByName, found).withColumn("_s", F.round("similarity", DIGITS))
    best = top_k_per_group(scored, ["seed"], [F.desc("_s"), "item"], k)
    return best.select("seed", "item", "rank", "users", "similarity")


def _heavy_scores(entries: DataFrame, own: DataFrame, measure: _Measure, k: int) -> DataFrame:
    """(seed, item, users, similarity) of the candidates that bounded prefixes leave to the items of ``own``."""
    ordered = running_sums(own, ["crowd", "user"], {"upto": F.col("mass")}, ["item"])
    floors = _floors(entries, own, measure, k).withColumnRenamed("seed", "item")
    placed = ordered.join(floors, "item", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)) - SLACK)
    before = 1 - (F.col("upto") - F.col("mass"))
    placed = settle(placed.withColumn("first", measure.most(before) >= F.col("floor")))
    prefix = placed.filter("first").select(F.col("item").alias("seed"), "user", F.col("w").alias("w0"), F.col("n").alias("n0"), "floor")
    left = placed.groupBy(F.col("item").alias("seed")).agg(F.sum(F.when(~F.col("first"), F.col("mass")).otherwise(0.0)).alias("left"))
    met = prefix.join(entries.select("item", "user", "w", "n"), "user").filter(F.col("seed") != F.col("item"))
    heads = met.groupBy("seed", "item").agg(F.count(F.lit(1)).alias("users"), F.sum(F.col("w0") * F.col("w")).alias("dot"), F.first("n").alias("n"), F.first("n0").alias("n0"), F.first("floor").alias("floor"))
    alive = settle(heads.join(left, "seed").filter(measure.bound(F.col("dot"), F.col("left"), F.col("n0")) >= F.col("floor")))
    tails = _summed(alive.select("seed", "item"), placed.filter(~F.col("first")), entries, measure).select(
        "seed", "item", F.col("users").alias("more"), F.col("dot").alias("rest"))
    whole = alive.join(tails, ["seed", "item"], "left").withColumns({
        "users": F.col("users") + F.coalesce("more", F.lit(0)), "dot": F.col("dot") + F.coalesce("rest", F.lit(0.0))})
    return whole.withColumn("similarity", measure.score(F.col("dot"), F.col("n"), F.col("n0"))).select("seed", "item", "users", "similarity")
