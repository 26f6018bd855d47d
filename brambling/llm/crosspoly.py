"""Near-duplicate vectors by cross-polytope hashing.

1. *Classes.*  Equal vectors form one class, so copies are hashed and compared once; a class counts with its
   number of rows.
2. *Hashing.*  A unit vector goes through three rounds of random signs and a fast Hadamard transform; its hash
   is the axis, with its sign, of the largest component.  Several such hashes in a row are a table's bucket.
   The more vectors, the more hashes a bucket is made of (about ``LOAD`` vectors a bucket), and tables are added
   until a simulation of pairs at exactly the threshold finds the share ``RECALL`` of them (`plan`).
3. *Multiprobe.*  Besides its home bucket a vector visits the ``PROBES`` next ones: those that lose least when
   a hash takes its second to fourth largest component.  Two vectors meet in a table if one visits the other's
   home.
4. *Verification.*  One table at a time, every bucket's home vectors are compared with all that visit it, by
   cosine in double precision on the whole vectors.  A pair counts in the first table where it meets.  Buckets
   above ``CELL`` vectors are cut into cells of a block of homes and a block of visitors, so a hot bucket
   spreads over tasks; what leaves a cell is one count per vector and a spanning forest of its links, never
   its pairs.

Pairs below the threshold are never linked; a pair at it or above is missed with a probability of at most
1 - RECALL.  Cosines closer to the threshold than 1e-12 are decided by an exactly rounded sum.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing and
form components of their own; vectors of different lengths do not link; rows that repeat an id are rows of
their own; a null id names a component only if all its ids are null; an empty table gives no rows; extra
columns are ignored.  Classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brambling.llm.cells import deal, pairs_of, parts, whole_runs
from brambling.llm.common import col, discard, settle
from brambling.llm.components import components
from brambling.llm.vectors import as_floats, blobs, by_width, finite, from_blobs, nonzero, unit

THRESHOLD = 0.95
RECALL = 0.998
LOAD = 8
PROBES = 3
CELL = 2_048
MAX_TABLES = 64
_RANKS = 4          # components a hash may fall on: the largest and the three after it
_NEAR = 1e-12


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the row length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, d)
        step *= 2
    return x


def rotations(d: int, table: int, width: int, seed: int) -> list[np.ndarray]:
    """The signs of a table's hashes: three rounds over the next power of two."""
    rng = np.random.default_rng([seed, d, table])
    padded = 1 << max(d - 1, 1).bit_length()
    return [rng.choice([-1.0, 1.0], (3, padded)) for _ in range(width)]


def codes(x: np.ndarray, table: int, width: int, probes: int, seed: int) -> np.ndarray:
    """(n, probes + 1) bucket numbers of unit vectors in one table, the home bucket first."""
    n, d = x.shape
    ranks, gaps = [], []
    for signs in rotations(d, table, width, seed):
        y = np.zeros((n, signs.shape[1]))
        y[:, :d] = x
        for s in signs:
            y = hadamard(y * s) / math.sqrt(signs.shape[1])
        size = np.abs(y)
        best = np.argsort(-size, axis=1, kind="stable")[:, :_RANKS]
        size = np.take_along_axis(size, best, 1)
        ranks.append(2 * best + (np.take_along_axis(y, best, 1) < 0))
        gaps.append((size[:, :1] - size) ** 2)
    axes, there = 2 * signs.shape[1], ranks[0].shape[1]
    choices = [(0,) * width]                                # at most two hashes leave their largest component
    for moved in range(1, min(width, 2) + 1):
        for which in itertools.combinations(range(width), moved):
            choices += [tuple(r[which.index(k)] if k in which else 0 for k in range(width))
                        for r in itertools.product(range(1, there), repeat=moved)]
    bucket = np.stack([sum(ranks[k][:, c[k]] * axes ** k for k in range(width)) for c in choices], 1)
    loss = np.stack([sum(gaps[k][:, c[k]] for k in range(width)) for c in choices], 1)
    loss[:, 0] = -1.0
    first = np.argsort(loss, axis=1, kind="stable")[:, :probes + 1]
    return np.take_along_axis(bucket, first, 1).astype(np.int64)


def meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of two code tables meet: one of them visits the other's home."""
    return (a[:, :1] == b).any(1) | (b[:, :1] == a).any(1)


def plan(n: int, d: int, threshold: float = THRESHOLD, recall: float = RECALL, probes: int = PROBES, load: int = LOAD, seed: int = 1) -> tuple[int, int]:
    """Hashes per bucket and number of tables for ``n`` vectors of length ``d``.

    Tables are added until simulated pairs with a cosine of exactly ``threshold`` meet in one of them.
    """
    axes = 2 << max(d - 1, 1).bit_length()
    most = int(62 / math.log2(axes))
    width = min(max(1, math.ceil(math.log(max(n, 1) / load + 1) / math.log(axes))), most)
    rng = np.random.default_rng(seed)
    x, z = rng.normal(size=(2, 4_000, d))
    x = unit(x)
    z -= np.einsum("ij,ij->i", x, z)[:, None] * x
    side = np.linalg.norm(z, axis=1, keepdims=True)
    y = threshold * x + math.sqrt(1 - threshold ** 2) * np.divide(z, side, out=np.zeros_like(z), where=side > 0) if d > 1 else x
    found = np.zeros(len(x), bool)
    for t in range(MAX_TABLES):
        found |= meet(codes(x, t, width, probes, seed), codes(y, t, width, probes, seed))
        if found.mean() >= recall:
            break
    return width, t + 1


def _hashed(classes: DataFrame, tables: list[int], upto: int, width: int, probes: int, seed: int, payload: bool) -> DataFrame:
    """A row per class, table and visited bucket; with ``payload`` the vector and its codes in all tables up to this one."""
    kind = "<f4" if "array<float>" in dict(classes.dtypes).values() else "<f8"

    def hash_(batches):
        for b in batches:
            vectors = b.column(b.schema.get_field_index("vector"))
            cls, copies = b.column(b.schema.get_field_index("cls")), b.column(b.schema.get_field_index("copies"))
            for rows, matrix in by_width(vectors):
                x = unit(matrix)
                all_ = {t: codes(x, t, width, probes, seed) for t in (range(upto + 1) if payload else tables)}
                m, p = len(rows), probes + 1
                for t in tables:
                    p = all_[t].shape[1]
                    columns = {"dim": np.full(m * p, matrix.shape[1], np.int32), "tab": np.full(m * p, t, np.int32),
                               "code": all_[t].ravel(), "home": np.tile(np.arange(p) == 0, m)}
                    out = {k: pa.array(v) for k, v in columns.items()}
                    if payload:
                        owner = pa.array(np.repeat(rows, p))
                        held = blobs(np.concatenate([all_[s] for s in range(upto + 1)], 1))
                        at = pa.array(np.repeat(np.arange(m), p))
                        out |= {"cls": cls.take(owner), "copies": copies.take(owner), "vec": blobs(matrix.astype(kind)).take(at), "held": held.take(at)}
                    yield pa.RecordBatch.from_pydict(out)

    more = ", cls long, copies long, vec binary, held binary" if payload else ""
    return classes.select("cls", "copies", "vector").mapInArrow(hash_, "dim int, tab int, code long, home boolean" + more)


def exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    """Cosine with exactly rounded sums."""
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def _linked(x: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    cos = np.einsum("ij,ij->i", x[i], x[j])
    yes = cos >= threshold
    for k in np.flatnonzero(np.abs(cos - threshold) < _NEAR):
        yes[k] = exact_cosine(x[i[k]], x[j[k]]) >= threshold
    return yes


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Numbers of links that join nodes not yet joined by the links before them."""
    root, kept = list(range(n)), []
    for k, (u, v) in enumerate(zip(a.tolist(), b.tolist())):
        while root[u] != u:
            root[u] = u = root[root[u]]
        while root[v] != v:
            root[v] = v = root[root[v]]
        if u != v:
            root[max(u, v)] = min(u, v)
            kept.append(k)
    return np.array(kept, np.int64)


def _compared(cells: DataFrame, table: int, probes: int, threshold: float, kind: str) -> DataFrame:
    """Counts (a, null, n) and spanning links (a, b, null) of every cell in one table."""
    keys = ["dim", "code", "lp", "rp"]

    def compare(batches):
        for b in whole_runs(batches, keys):
            get = lambda c: b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
            dim, key = get("dim"), {k: get(k) for k in keys}
            edge = np.concatenate([[0], np.flatnonzero(dim[1:] != dim[:-1]) + 1, [len(dim)]])
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
                part, d = slice(lo, hi), int(dim[lo])
                start = np.ones(hi - lo, bool)
                start[1:] = False
                for k in keys:
                    start[1:] |= key[k][part][1:] != key[k][part][:-1]
                cls, copies = get("cls")[part], get("copies")[part]
                x = unit(from_blobs(b.column(b.schema.get_field_index("vec")).slice(lo, hi - lo), kind, d).astype(np.float64))
                held = b.column(b.schema.get_field_index("held")).slice(lo, hi - lo)
                wide = len(held[0].as_py()) // 8 // (table + 1)
                held = from_blobs(held, "<i8", wide * (table + 1)).reshape(-1, table + 1, wide)
                home, left, right = get("home")[part], get("left")[part], get("right")[part]
                total, links = np.zeros(hi - lo, np.int64), []
                for i, j in pairs_of(start, left, right, 2_000_000 // max(d, 8)):
                    keep = (cls[i] != cls[j]) & ~(home[j] & (cls[i] > cls[j]))
                    i, j = i[keep], j[keep]
                    yes = _linked(x, i, j, threshold)
                    i, j = i[yes], j[yes]
                    # a pair that also meets in the other one's home counts in the home of the lesser class
                    again = ~home[j] & (held[j, table, :1] == held[i, table]).any(1) & (cls[i] > cls[j])
                    for s in range(table):
                        again |= meet(held[i, s], held[j, s])
                    i, j = i[~again], j[~again]
                    if len(i):
                        total += np.bincount(i, copies[j], len(total)).astype(np.int64) + np.bincount(j, copies[i], len(total)).astype(np.int64)
                        few = _forest(i, j, len(total))
                        links.append(np.stack([cls[i[few]], cls[j[few]]]))
                some = np.flatnonzero(total)
                if len(some):
                    pairs = np.concatenate(links, 1)
                    a = pa.array(np.concatenate([cls[some], pairs[0]]))
                    second = pa.array(np.concatenate([np.zeros(len(some), np.int64), pairs[1]]), mask=np.arange(len(a)) < len(some))
                    count = pa.array(np.concatenate([total[some], np.zeros(pairs.shape[1], np.int64)]), mask=np.arange(len(a)) >= len(some))
                    yield pa.RecordBatch.from_arrays([a, second, count], names=["a", "b", "n"])

    dealt = cells.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(compare, "a long, b long, n long")


def near_vectors(df: DataFrame, threshold: float = THRESHOLD, id: str = "vec_id", vector: str = "embedding", recall: float = RECALL,
                 probes: int = PROBES, cell: int = CELL, seed: int = 1) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row: how many others link with it, and the least id that links reach."""
    v = as_floats(df, vector)
    signed = df.select(col(id).alias("vec_id"), v.alias("vector")).withColumn("cls", F.when(finite(F.col("vector")) & nonzero(F.col("vector")), F.xxhash64("vector")))
    usable = signed.filter(F.col("cls").isNotNull())
    classes = settle(usable.groupBy("cls").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")))
    n, d = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    found = []
    if n:
        width, tables = plan(n, d, threshold, recall, probes, seed=seed)
        kind = "<f4" if "array<float>" in dict(classes.dtypes).values() else "<f8"
        sizes = (_hashed(classes, list(range(tables)), 0, width, probes, seed, False).groupBy("dim", "tab", "code")
                 .agg(F.count_if("home").alias("h"), F.count(F.lit(1)).alias("r")).filter((F.col("h") > 0) & (F.col("r") > cell)))
        heavy = settle(sizes.select("dim", "tab", "code", parts("h", cell).alias("nl"), parts("r", cell).alias("nr")))
        hot = {row["tab"] for row in heavy.select("tab").distinct().collect()}
        for t in range(tables):
            keyed = _hashed(classes, [t], t, width, probes, seed, True)
            found.append(settle(_compared(deal(keyed, heavy if t in hot else None), t, probes, threshold, kind)))
    met = classes.select("cls", "rep", "copies").withColumns({"n": F.lit(0).cast("long"), "component": F.col("cls")})
    if found:
        all_ = found[0]
        for more in found[1:]:
            all_ = all_.union(more)
        counts = all_.filter(F.col("n").isNotNull()).groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("linked"))
        groups = settle(components(all_.filter(F.col("b").isNotNull()).select("a", "b"))).select(F.col("node").alias("cls"), F.col("component").alias("found"))
        met = (met.join(counts, "cls", "left").join(groups, "cls", "left")
               .select("cls", "rep", "copies", F.coalesce("linked", "n").alias("n"), F.coalesce("found", "component").alias("component")))
    smallest = met.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = settle(met.join(smallest, "component").select("cls", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id"))
    for part in found:
        discard(part)
    joined = usable.select("vec_id", "cls").join(of_class, "cls").select("vec_id", "n_links", "component_id")
    alone = signed.filter(F.col("cls").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
