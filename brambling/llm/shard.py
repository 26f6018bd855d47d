"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``replicas`` points of a 64-bit ring; a document belongs to the first point at or
after the hash of its text, so equal texts meet on one shard while it has room.  A shard takes its
own documents in ring order up to its capacity; what overflows continues clockwise to the next
point whose shard has room.  The ring has ``shards * replicas`` arcs whatever the data's size: only
one count per arc reaches the driver, which cuts the arcs into intervals and names a shard for each.
Rows find their interval by their running position inside the arc, so no task holds a whole arc.

Defined cases: a null text hashes as an empty text and weighs one byte; copies of one row are told
apart by their place in the input and differ in the slot only; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from brambling.llm.common import col, row_tag, settle
from brambling.operators.ordering import number_rows, running_sums

REPLICAS = 128


def ring(shards: int, replicas: int = REPLICAS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ring points (signed 64 bit) and the shard that owns each."""
    points = [(int.from_bytes(hashlib.blake2b(f"{seed}/{s}/{r}".encode(), digest_size=8).digest(), "little", signed=True), s)
              for s in range(shards) for r in range(replicas)]
    points.sort()
    return np.array([p for p, _ in points], np.int64), np.array([s for _, s in points], np.int64)


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Load each shard may hold; without slack they sum to ``total`` and differ by one at most."""
    if slack > 0:
        return [int(np.ceil((1 + slack) * total / shards))] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def intervals(loads: dict[int, int], owners: np.ndarray, capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Cut arcs into (arc, from, to, shard, load of the shard before); ``loads`` is the load of each arc."""
    room, used = list(capacity), [0] * len(capacity)
    out, over = [], []

    def take(arc: int, lo: int, hi: int, shard: int) -> int:
        n = min(room[shard], hi - lo)
        if n > 0:
            out.append((arc, lo, lo + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return lo + max(n, 0)

    for arc in sorted(loads):
        left = take(arc, 0, loads[arc], int(owners[arc]))
        if left < loads[arc]:
            over.append((arc, left, loads[arc]))
    for arc, lo, hi in over:
        at = arc
        while lo < hi:
            at = (at + 1) % len(owners)
            lo = take(arc, lo, hi, int(owners[at]))
    return out


def assign(docs: DataFrame, shards: int, law: str = "rows", slack: float = 0.0, replicas: int = REPLICAS,
           seed: int = 7, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, home, shard, slot): a shard below ``shards`` for every row.

    ``law`` is what the capacity counts: ``rows``, or ``bytes`` of text plus one each.  With no slack
    the row counts of two shards differ by one at most; byte loads may differ by a document for
    every interval.  ``home`` is the shard the ring alone would name.
    """
    if law not in ("rows", "bytes"):
        raise ValueError("law is rows or bytes")
    spark = docs.sparkSession
    points, owners = ring(shards, replicas, seed)

    @F.pandas_udf("int")
    def arc_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, at.to_numpy(np.int64)) % len(points), dtype="int32")

    body = F.coalesce(col(text), F.lit(""))
    keyed = docs.select(
        col(id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(F.encode(body, "utf-8")).alias("text_crc32"), F.xxhash64(body).alias("at"))
    keyed = keyed.select("*", arc_of("at").alias("arc"), F.xxhash64("doc_id").alias("turn"), row_tag().alias("tag"))
    weight = F.lit(1).cast("long") if law == "rows" else F.col("size")
    placed = settle(running_sums(keyed, ["at", "turn", "doc_id", "tag"], {"upto": weight}, ["arc"]))
    loads = {r.arc: r.load for r in placed.groupBy("arc").agg(F.max("upto").alias("load")).collect()}  # a row per arc of the ring
    cut = intervals(loads, owners, capacities(sum(loads.values()), shards, slack))
    cuts = spark.createDataFrame([(*c, int(owners[c[0]])) for c in cut], "c_arc int, lo long, hi long, shard int, before long, home int")
    start = F.col("upto") - weight
    met = placed.join(F.broadcast(cuts), (F.col("arc") == F.col("c_arc")) & (start >= F.col("lo")) & (start < F.col("hi")))
    out = met.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "home", "shard",
                     (F.col("before") + start - F.col("lo")).alias("slot"), "at", "turn", "tag")
    if law == "bytes":
        out = number_rows(out.drop("slot"), ["at", "turn", "doc_id", "tag"], "slot", ["shard"]).withColumn("slot", F.col("slot") - 1)
    return out.select("doc_id", "size", "text_crc32", "law", "home", "shard", "slot")
