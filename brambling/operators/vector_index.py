"""Approximate nearest vectors by an inverted-file index.

The centres come from spherical k-means on a sample of at most ``SAMPLE`` rows, drawn by hash; every usable row is filed
under its nearest centre, in blocks of at most ``BLOCK`` rows of one list, so a crowded list is many blocks.  A query looks
into the lists of its nearest centres; blocks of queries meet blocks of rows, each meeting gives the ``k`` best of every
query, by exact cosine in double precision, and these are ranked in Spark.  No pair of a query and a row becomes a row.

How many lists to look into is measured when the index is built: sample rows are searched among the sample, whole and
by list, and the fewest probes whose recall reaches ``RECALL`` are kept (all lists give the exact result).

Vectors that are null, empty, zero, of another length than most, or hold a null or non-finite component are not indexed
and find nothing; ties go to the smaller id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brambling.operators.ordering import top_k_per_group
from brambling.session import settle

SAMPLE, MAX_LISTS, BLOCK, RECALL, TESTED = 20_000, 4_096, 1_024, 0.95, 200
HELD = 2_000_000        # numbers that a task holds at a time
DIGITS = 9


@dataclass(frozen=True)
class VectorIndex:
    """Centres (lists, d), the filed blocks (list, ids, vectors), and the number of lists a query looks into."""
    centres: np.ndarray
    blocks: DataFrame
    probes: int
    width: int


def _usable(rows: DataFrame, id: str, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select(F.col(id).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & (F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0))


def _matrix(lists: pa.Array) -> np.ndarray:
    x = lists.flatten().to_numpy().reshape(len(lists), -1)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Centres of length one; an empty one takes a row that lies far from its own."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = x @ centres.T
        best = near.argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, best, x)
        length = np.linalg.norm(total, axis=1)
        gone = np.flatnonzero(length == 0)
        total[gone] = x[np.argsort(near.max(1))[:len(gone)]]
        centres = total / np.where(length == 0, 1, length)[:, None]
    return centres


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int = 10, recall: float = RECALL, tested: int = TESTED) -> int:
    """The fewest nearest lists that hold the share ``recall`` of the sample's true neighbours."""
    queries = sample[:tested]
    own, lists = (sample @ centres.T).argmax(1), np.argsort(-(queries @ centres.T), axis=1, kind="stable")
    true = np.argsort(-(queries @ sample.T), axis=1, kind="stable")[:, :k]
    place = np.argsort(lists, axis=1)                       # at which probe a list is looked into
    needed = np.sort(np.take_along_axis(place, own[true], 1).ravel()) + 1
    return int(needed[max(math.ceil(recall * len(needed)) - 1, 0)]) if len(needed) else 1


def _slices(batches, numbers: int):
    """Parts of the batches whose rows, of so many numbers each, hold at most ``HELD`` numbers together."""
    step = max(HELD // numbers, 1)
    for b in batches:
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def build(rows: DataFrame, id: str, vector: str, lists: int | None = None, sample_rows: int = SAMPLE, block: int = BLOCK, recall: float = RECALL) -> VectorIndex | None:
    """File every usable row; None if there is none."""
    usable = _usable(rows, id, vector)
    widths = usable.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if widths is None:
        return None
    d, n = widths
    usable = usable.filter(F.size("v") == d)
    # the rate keeps what the tasks send near the size of the sample
    part = usable if n <= 2 * sample_rows else usable.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < math.ceil(2e6 * sample_rows / n))
    taken = part.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow()
    sample = _matrix(taken.column(0).combine_chunks())
    k = min(lists or math.ceil(math.sqrt(n)), MAX_LISTS, len(sample))
    centres = k_means(sample, k)
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def file(batches):
        for b in _slices(batches, k + d):
            near = (_matrix(b.column(1)) @ shared.value.T).argmax(1)
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.int32()), b.column(0), b.column(1)], names=["list", "id", "v"])

    def blocks(batches):
        for b in batches:
            where = b.column(0).to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(where[1:] != where[:-1]) + 1, [b.num_rows]]) if b.num_rows else [0]
            for lo, hi in zip(edges[:-1], edges[1:]):
                for at in range(int(lo), int(hi), block):
                    part = b.slice(at, min(block, int(hi) - at))
                    x = _matrix(part.column(2))
                    yield pa.RecordBatch.from_arrays([part.column(0).slice(0, 1), *[pa.array([a.tobytes()], pa.binary()) for a in (part.column(1).to_numpy(), x)]], names=["list", "ids", "vectors"])

    filed = usable.mapInArrow(file, "list int, id long, v array<double>")
    # dealt by list and hash, so that a crowded list is filed by several tasks
    dealt = filed.repartition("list", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("list", "id")
    return VectorIndex(centres, settle(dealt.mapInArrow(blocks, "list int, ids binary, vectors binary")), probes_needed(sample, centres, recall=recall), d)


def search(index: VectorIndex, queries: DataFrame, id: str, vector: str, k: int = 10, probes: int | None = None, group: int = 256) -> DataFrame:
    """(query_id, rank, id, similarity): the ``k`` nearest other rows that the lists looked into hold."""
    shared = queries.sparkSession.sparkContext.broadcast(index.centres)
    looks = min(probes or index.probes, len(index.centres))
    numbers = 3 * len(index.centres) + looks * index.width

    def places(batches):
        for b in _slices(batches, numbers):
            near = np.argsort(-(_matrix(b.column(1)) @ shared.value.T), axis=1, kind="stable")[:, :looks]
            row = pa.array(np.repeat(np.arange(b.num_rows), looks))
            yield pa.RecordBatch.from_arrays([pa.array(near.ravel(), pa.int32()), b.column(0).take(row), b.column(1).take(row)], names=["list", "id", "v"])

    asked = _usable(queries, id, vector).filter(F.size("v") == index.width)
    there = settle(asked.mapInArrow(places, "list int, id long, v array<double>"))
    parts = there.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / group).cast("int").alias("parts"))
    grouped = (there.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).groupBy("list", "part")
               .agg(F.collect_list(F.struct("id", "v")).alias("queries")))
    met = index.blocks.join(grouped, "list").select("ids", "vectors", "queries")

    def nearest(batches):
        for b in batches:
            for row in range(b.num_rows):
                ids = np.frombuffer(b.column(0)[row].as_py(), np.int64)
                x = np.frombuffer(b.column(1)[row].as_py(), np.float64).reshape(len(ids), -1)
                held = b.column(2)[row].values
                asked = held.field("id").to_numpy()
                cosine = np.round(_matrix(held.field("v")) @ x.T, 12)
                cosine[asked[:, None] == ids] = -np.inf
                best = np.argsort(-cosine, axis=1, kind="stable")[:, :k]          # ids ascend inside a block
                score = np.take_along_axis(cosine, best, 1)
                q, c = np.nonzero(score > -np.inf)
                yield pa.RecordBatch.from_arrays([pa.array(asked[q]), pa.array(ids[best[q, c]]), pa.array(score[q, c])], names=["query_id", "id", "similarity"])

    found = met.mapInArrow(nearest, "query_id long, id long, similarity double").withColumn("_s", F.round("similarity", DIGITS))
    return top_k_per_group(found, ["query_id"], [F.desc("_s"), "id"], k).select("query_id", "rank", "id", "similarity")
