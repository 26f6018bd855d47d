"""Hard-negative mining with exact scores from subset-sum tables ("Four Russians").

Components become whole numbers, floor(256 x), and a row's score is its inner product with the anchor.

1. *Index.*  Rows are packed into blocks: bit p of eight neighbouring components, in two's complement, is one byte,
   so a block holds a byte per row, group of eight dimensions and bit plane.
2. *Tables.*  For every anchor and group of eight dimensions the sums of all 256 subsets of its components are
   computed by doubling.
3. *Scores.*  One bit plane's inner products are a table lookup per group, added up; the planes are added from the
   top down, the sum shifted by one bit each time, the sign plane counting negative.  That is the exact score.
4. *Mining.*  Anchors, the stated query set, meet the index block by block.  The first pass scores rows of the
   anchor's label only and keeps each anchor's best positives; the second keeps, for each positive, the best rows of
   other labels whose score lies between ``low`` percent of the positive's and all of it.  Every pair of blocks gives
   its few best, which are ranked in Spark.

Defined cases: rows with a null id, label or vector or a null or non-finite component take no part, nor do those
with a component of 65,536 or more (scores would leave 64 bits); missing components of a shorter vector count as 0;
an anchor's others are the rows with another id, and rows that repeat an id are rows of their own, also as anchors;
an anchor without positives or a positive without negatives gives no rows; empty tables give no rows; extra columns
are ignored.  Ids and labels are whole numbers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from brambling.llm.common import col, settle

SCALE = 256
LIMIT = 1 << 24        # a whole-number component is below this in size
ROWS = 1_024           # rows of an index block
ANCHORS = 64           # anchors of a block, on average
POSITIVES, NEGATIVES, LOW = 5, 5, 80


def planes(q: np.ndarray) -> np.ndarray:
    """(bits, groups, rows) bytes of whole numbers (rows, dimensions); the last plane is the sign."""
    bits = int(max(q.max(initial=0), -1 - q.min(initial=0))).bit_length() + 1
    return np.stack([np.packbits((q >> p & 1).astype(np.uint8), axis=1, bitorder="little").T for p in range(bits)])


def subset_sums(q: np.ndarray) -> np.ndarray:
    """(anchors, groups, 256) sums of all subsets of eight neighbouring components."""
    n, d = q.shape
    groups = -(-d // 8)
    whole = np.zeros((n, groups * 8), np.int64)
    whole[:, :d] = q
    whole = whole.reshape(n, groups, 8)
    sums = np.zeros((n, groups, 1), np.int64)
    for k in range(8):
        sums = np.concatenate([sums, sums + whole[:, :, k:k + 1]], 2)
    return sums


def scores(sums: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """(anchors, rows) inner products."""
    groups = min(sums.shape[1], bits.shape[1])
    bound = int(np.abs(sums[:, :groups]).max(2, initial=0).sum(1).max(initial=0)) << len(bits)
    sums = sums.astype(np.int32 if bound < 1 << 31 else np.int64)
    total = np.zeros((len(sums), bits.shape[2]), sums.dtype)
    for p in range(len(bits) - 1, -1, -1):
        plane = np.zeros_like(total)
        for g in range(groups):
            plane += sums[:, g].take(bits[p, g], axis=1)
        total = 2 * total - plane if p == len(bits) - 1 else 2 * total + plane
    return total.astype(np.int64)


def _whole(v: Column) -> Column:
    """Components as whole numbers; null where one is missing, not finite or too large."""
    x = F.transform(v.cast("array<double>"), lambda x: x)
    fits = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LIMIT / SCALE)
    return F.when(F.forall(x, fits), F.transform(x, lambda e: F.floor(e * SCALE).cast("int")))


def index(rows: DataFrame, size: int = ROWS) -> DataFrame:
    """Blocks of at most ``size`` rows, each sorted by label and id: (n, groups, ids, labels, bits)."""

    def block(batches):
        for b in batches:
            for lo in range(0, b.num_rows, size):
                part = b.slice(lo, size)
                ids, labels = part.column(0).to_numpy(), part.column(1).to_numpy()
                order = np.lexsort((ids, labels))
                packed = planes(matrix(part.column(2))[order])
                yield pa.RecordBatch.from_arrays([pa.array([len(ids)]), pa.array([packed.shape[1]]), *[pa.array([v.tobytes()], pa.binary()) for v in (ids[order], labels[order], packed)]],
                                                 names=["n", "groups", "ids", "labels", "bits"])

    return rows.select("id", "label", "q").mapInArrow(block, "n long, groups long, ids binary, labels binary, bits binary")


def matrix(lists: pa.Array) -> np.ndarray:
    """Lists as the rows of a matrix; shorter ones end in zeros."""
    bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    width = np.diff(bounds)
    out = np.zeros((len(lists), max(int(width.max(initial=0)), 1)), np.int64)
    out[np.arange(out.shape[1]) < width[:, None]] = lists.flatten().to_numpy()
    return out


def _met(blocks: DataFrame, anchors: DataFrame, cells: int) -> DataFrame:
    """Every index block with every block of anchors; both are dealt to at least ``cells`` keys, so no key grows hot."""
    n = max(1, -(-anchors.count() // ANCHORS))
    slices = max(1, -(-cells // n))
    grouped = (anchors.withColumn("ab", F.pmod(F.xxhash64("tag"), F.lit(n)).cast("int")).groupBy("ab")
               .agg(F.collect_list(F.struct("tag", "id", "label", "q", "found")).alias("anchors"))
               .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))))
    dealt = blocks.withColumn("slice", F.pmod(F.xxhash64("ids"), F.lit(slices)).cast("int")).withColumn("ab", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return dealt.join(grouped, ["ab", "slice"]).select("ab", "n", "groups", "ids", "labels", "bits", "anchors")


def _best(key: np.ndarray, score: np.ndarray, id: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of every key by descending score, then id."""
    order = np.lexsort((id, -score, key))
    sorted_ = key[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_, sorted_) < k]


def _mined(met: DataFrame, positives: bool, k: int, low: int) -> DataFrame:
    """(tag, place, id, score): the first ``k`` positives of an anchor, or negatives of its positive number ``place``, in each pair of blocks."""
    share = math.gcd(low, 100)

    def mine(batches):
        last, tag, own, label, sums, limits = None, *[None] * 5
        for b in batches:
            for row in range(b.num_rows):
                ab, n, groups, ids, labels, bits, anchors = (b.column(c)[row] for c in range(7))
                if ab.as_py() != last:
                    last, held = ab.as_py(), anchors.values.flatten()
                    tag, own, label = (held[c].to_numpy() for c in range(3))
                    sums = subset_sums(matrix(held[3]))
                    if not positives:
                        limits = np.full((len(tag), int(np.diff(held[4].offsets.to_numpy()).max(initial=0))), -1)
                        width = np.diff(held[4].offsets.to_numpy())
                        limits[np.arange(limits.shape[1]) < width[:, None]] = held[4].flatten().to_numpy()
                ids, labels = (np.frombuffer(v.as_py(), np.int64) for v in (ids, labels))
                bits = np.frombuffer(bits.as_py(), np.uint8).reshape(-1, groups.as_py(), n.as_py())
                a, c, s, place = _same(sums, bits, own, label, ids, labels, k) if positives else _others(sums, bits, label, labels, ids, limits, k, low // share, 100 // share)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(tag[a]), pa.array(place), pa.array(ids[c]), pa.array(s)], names=["tag", "place", "id", "score"])

    return met.mapInArrow(mine, "tag long, place long, id long, score long")


def _same(sums, bits, own, label, ids, labels, k):
    """The best rows of the anchors' labels in one block."""
    parts = []
    for value in np.intersect1d(label, labels):
        which = np.flatnonzero(label == value)
        lo, hi = np.searchsorted(labels, value), np.searchsorted(labels, value, "right")
        s = scores(sums[which], bits[:, :, lo:hi])
        a, c = np.nonzero(own[which][:, None] != ids[lo:hi])
        top = _best(a, s[a, c], ids[lo + c], k)
        parts.append((which[a[top]], lo + c[top], s[a[top], c[top]]))
    a, c, s = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in range(3))
    return a, c, s, np.zeros(len(a), np.int64)


def _others(sums, bits, label, labels, ids, limits, k, num, den):
    """The best rows of other labels below each positive's score in one block; positives without a score are -1 and find none, as negative scores do."""
    s = scores(sums, bits)
    there = limits >= 0
    most = np.where(there, limits, -1).max(1, initial=-1)
    least = np.where(there, limits, np.iinfo(np.int64).max // 8).min(1, initial=np.iinfo(np.int64).max // 8)
    a, c = np.nonzero((num * least[:, None] <= den * s) & (s <= most[:, None]) & (label[:, None] != labels))
    parts = []
    for place in range(limits.shape[1]):
        limit = limits[a, place]
        fits = np.flatnonzero((limit >= 0) & (num * limit <= den * s[a, c]) & (s[a, c] <= limit))
        top = fits[_best(a[fits], s[a[fits], c[fits]], ids[c[fits]], k)]
        parts.append((a[top], c[top], s[a[top], c[top]], np.full(len(top), place)))
    return tuple(np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in range(4))


def hard_negatives(df: DataFrame, is_anchor: Column, id: str = "vec_id", label: str = "label", vector: str = "embedding",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``is_anchor`` picks.

    A positive with a negative score has no negatives: no number lies between ``low`` percent of it and itself.
    """
    spark = df.sparkSession
    rows = df.select(col(id).cast("long").alias("id"), col(label).cast("long").alias("label"), _whole(col(vector)).alias("q"), is_anchor.alias("anchor"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("q").isNotNull())
    anchors = settle(rows.filter("anchor").select("id", "label", "q", F.monotonically_increasing_id().alias("tag")))
    blocks = settle(index(rows))
    cells = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = lambda keys: Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    near = _mined(_met(blocks, anchors.withColumn("found", F.array().cast("array<long>")), cells), True, positives, low)
    near = settle(near.withColumn("k", F.row_number().over(first(["tag"]))).filter(F.col("k") <= positives).select("tag", F.col("k") - 1, F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).toDF("tag", "place", "positive_id", "positive_score"))
    limits = near.groupBy("tag").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "positive_score"))), lambda s: s["positive_score"]).alias("found"))
    far = _mined(_met(blocks, settle(anchors.join(limits, "tag")), cells), False, negatives, low)
    far = far.withColumn("rank", F.row_number().over(first(["tag", "place"]))).filter(F.col("rank") <= negatives)
    named = near.join(anchors.select("tag", F.col("id").alias("anchor_id")), "tag")
    return (far.withColumn("place", F.col("place").cast("int")).join(named, ["tag", "place"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
