"""Random forests by Spark's rules, grown from binned rows that are packed once.

Every tree draws its rows with replacement (a Poisson number of draws, each row alike), every node its features; a split is
the edge of greatest gain that leaves enough rows on both sides; leaves that say the same are joined.  Rows are packed into
pieces of bins, and a task takes a chunk of pieces and a share of the trees.  What leaves it are sums:

* few different cells of bins (``TABLE``): a tree's draws are added up by cell, and its levels read the cells;
* many: one pass a level adds up the bins of each open node, from the same draws (they are seeded by piece and tree).

The driver holds the nodes of the forest.  The result is Spark's model, read from what its own writer would have written.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from brambling.session import new_path, settings, settle

PIECE, CHUNK = 100_000, 8_000_000   # rows packed together, and rows whose sums leave a task together
SEEN = 16                           # pieces that a task looks at together
TABLE = 65_536                      # cells up to which a tree's draws are added up by cell
HELD = 64_000_000                   # bytes of sums that a task holds at most, one tree's sums apart
DEPTH = 12                          # nodes are numbered as in a heap, so deeper trees are left to Spark
NODE = "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, " \
       "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
SPLIT = "tree int, node int, feature int, cut int, gain double, total array<double>, below array<double>, above array<double>"


def suits(estimator) -> bool:
    """Whether the estimator is a forest with no setting but those followed here."""
    return (isinstance(estimator, (RandomForestClassifier, RandomForestRegressor)) and estimator.getBootstrap() and estimator.getSubsamplingRate() == 1.0
            and not estimator.isSet(estimator.weightCol) and estimator.getMinWeightFractionPerNode() == 0.0 and 0 < estimator.getMaxDepth() <= DEPTH)


def subset_size(strategy: str, width: int, trees: int, classes: bool) -> int:
    """How many features a node looks at."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt" if classes else "onethird"
    if strategy in ("all", "onethird", "sqrt", "log2"):
        return {"all": width, "onethird": math.ceil(width / 3), "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width)))}[strategy]
    return min(int(strategy), width) if strategy.isdigit() else math.ceil(float(strategy) * width)


def _impurity(kind: str, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Impurity and number of draws of sums (last axis): counts by class, or number, sum and sum of squares."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if kind == "variance":
            n = s[..., 0]
            return np.where(n > 0, (s[..., 2] - s[..., 1] * s[..., 1] / n) / n, 0.0), n
        n = s.sum(-1)
        p = s / n[..., None]
        value = 1 - (p * p).sum(-1) if kind == "gini" else -np.where(p > 0, p * np.log2(np.where(p > 0, p, 1)), 0.0).sum(-1)
        return np.where(n > 0, value, 0.0), n


class _Rules:
    """What tasks need to know of the forest."""

    def __init__(self, estimator, width: int, bins: int, classes: int):
        self.trees, self.depth, self.seed = estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getSeed() & 0xFFFFFFFF
        self.kind, self.least, self.gain = estimator.getImpurity(), estimator.getMinInstancesPerNode(), estimator.getMinInfoGain()
        self.width, self.bins, self.classes, self.sums = width, bins, classes, classes or 3
        self.looked = subset_size(estimator.getFeatureSubsetStrategy(), width, self.trees, classes > 0)

    def drawn(self, tree: int, piece: int, n: int) -> np.ndarray:
        """The rows of a piece that the tree draws."""
        rng = np.random.default_rng([self.seed, tree, piece])
        return rng.integers(0, n, rng.poisson(n), dtype=np.uint32)

    def subsets(self, tree: int, level: int) -> np.ndarray:
        """The features that each node of a level looks at."""
        if self.looked == self.width:
            return np.broadcast_to(np.arange(self.width), (1 << level, self.width))
        return np.random.default_rng([self.seed, tree, level, 1]).random((1 << level, self.width)).argsort(1)[:, :self.looked]

    def added(self, code: np.ndarray, size: int, weight: np.ndarray | None, label: np.ndarray) -> np.ndarray:
        """Sums by code: (size, sums)."""
        if self.classes:
            return np.bincount(code * self.classes + label, weight, size * self.classes).reshape(size, self.classes)
        wy = label if weight is None else weight * label
        return np.stack([np.bincount(code, weight, size), np.bincount(code, wy, size), np.bincount(code, wy * label, size)], 1)

    def best(self, found: np.ndarray, nodes: np.ndarray, looked: np.ndarray, tree: int) -> list[tuple]:
        """The split of each node from its sums (node, feature looked at, bin, sums); feature -1 if there is none."""
        total = found[:, 0].sum(1)
        below = found.cumsum(2)[:, :, :-1]
        above = total[:, None, None] - below
        (whole, n), (left, nl), (right, nr) = (_impurity(self.kind, s) for s in (total, below, above))
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = whole[:, None, None] - nl / n[:, None, None] * left - nr / n[:, None, None] * right
        gain = np.where((nl >= self.least) & (nr >= self.least) & (gain >= self.gain), gain, -1.0)
        flat = gain.reshape(len(nodes), -1)
        at = flat.argmax(1) if flat.shape[1] else np.zeros(len(nodes), int)
        out = []
        for i, (node, k) in enumerate(zip(nodes.tolist(), at.tolist())):
            if flat.shape[1] and flat[i, k] > 0:
                j, cut = divmod(k, self.bins - 1)
                out.append((tree, node, int(looked[i, j]), cut, float(flat[i, k]), total[i].tolist(), below[i, j, cut].tolist(), above[i, j, cut].tolist()))
            else:
                out.append((tree, node, -1, 0, -1.0, total[i].tolist(), None, None))
        return out

    def opened(self, split: tuple) -> list[int]:
        """The children of a split that may be split again."""
        _, node, feature, *_, below, above = split
        if feature < 0 or (node + 2).bit_length() > self.depth:          # the children's level is the number of bits less one
            return []
        return [child for child, s in ((2 * node + 1, below), (2 * node + 2, above)) if abs(_impurity(self.kind, np.array(s))[0]) > 2.3e-16]


def _grown(rules: _Rules, tree: int, sums: np.ndarray, strides: list[int], shape: list[int]) -> list[tuple]:
    """All splits of a tree from its sums by cell."""
    cells = np.flatnonzero(sums[:, 0] if not rules.classes else sums.any(1))
    sums, bins = sums[cells], np.stack([cells // s % w for s, w in zip(strides, shape)], 1)
    node, opened, out = np.zeros(len(cells), np.int64), np.array([0]), []
    for level in range(rules.depth):
        first = (1 << level) - 1
        slot = np.full(1 << level, -1)
        slot[opened - first] = np.arange(len(opened))
        looked = rules.subsets(tree, level)[opened - first]
        s = slot[node - first]
        sums, bins, node, s = (a[s >= 0] for a in (sums, bins, node, s))
        found = np.empty((len(opened), rules.looked, rules.bins, rules.sums))
        for j in range(rules.looked):
            code = s * rules.bins + bins[np.arange(len(bins)), looked[s, j]]
            for k in range(rules.sums):
                found[:, j, :, k] = np.bincount(code, sums[:, k], len(opened) * rules.bins).reshape(-1, rules.bins)
        splits = rules.best(found, opened, looked, tree)
        out += splits
        feature, cut = np.array([x[2] for x in splits]), np.array([x[3] for x in splits])
        node = 2 * node + 1 + (bins[np.arange(len(bins)), feature[s]] > cut[s])
        kept = feature[s] >= 0
        sums, bins, node = sums[kept], bins[kept], node[kept]
        opened = np.array([c for x in splits for c in rules.opened(x)], int)
        if not len(opened):
            break
        live = np.isin(node, opened)
        sums, bins, node = sums[live], bins[live], node[live]
    return out


def _split_batch(splits: list[tuple], kind=pa.RecordBatch):
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), *[pa.list_(pa.float64())] * 3]
    columns = zip(*splits) if splits else [()] * 8
    return kind.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["tree", "node", "feature", "cut", "gain", "total", "below", "above"])


def packed(rows: DataFrame, edges: list[list[float]], classes: int) -> DataFrame:
    """(piece, n, bins, label): rows of (label, features) as bytes, ``PIECE`` of them together."""
    cuts, kind = [np.array(e, float) for e in edges], _kind(edges)

    def pack(batches):
        part, made, held, count = TaskContext.get().partitionId(), 0, [], 0

        def piece():
            bins, label = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + made], pa.int64()), pa.array([len(label)], pa.int32()), pa.array([bins.tobytes()], pa.binary()),
                                               pa.array([label.tobytes()], pa.binary())], names=["piece", "n", "bins", "label"])

        for b in batches:
            if b.num_rows:
                values = [b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)]
                held.append((np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, values[1:])], 1).astype(kind), values[0].astype(np.uint8 if classes else float)))
                count += b.num_rows
            if count >= PIECE:
                yield piece()
                held, count, made = [], 0, made + 1
        if held:
            yield piece()

    return settle(rows.mapInArrow(pack, "piece long, n int, bins binary, label binary"))


def _kind(edges) -> type:
    return np.uint8 if max(map(len, edges)) < 256 else np.int32


def _pieces(batches, kind, width: int, classes: int):
    """(piece, share, bins, label) of packed rows."""
    for b in batches:
        for piece, n, bins, label, share in zip(*(b.column(i).to_pylist() for i in range(5))):
            yield piece, share, np.frombuffer(bins, kind).reshape(n, width), np.frombuffer(label, np.uint8 if classes else float)


def splits(estimator, rows: DataFrame, edges: list[list[float]], classes: int, count: int) -> list[tuple]:
    """The splits of all trees; ``rows`` are (label, features)."""
    spark, width = rows.sparkSession, len(edges)
    shape = [len(e) + 1 for e in edges]
    rules, kind = _Rules(estimator, width, max(shape), classes), _kind(edges)
    table = math.prod(shape)
    pieces = packed(rows, edges, classes)
    chunks = max(math.ceil(count / CHUNK), 1)

    def summed(fn, size: int, best) -> list[tuple]:
        """``best(tree, sums)`` of the sums of all chunks; ``fn(tree, piece, bins, label)`` are those of one piece, of ``size`` bytes a tree."""
        shares = min(rules.trees, max(math.ceil(3 * spark.sparkContext.defaultParallelism / chunks), math.ceil(rules.trees * size / HELD)))
        # every chunk meets every share of the trees; the pieces are read again and not shuffled
        met = pieces.coalesce(chunks).hint("shuffle_replicate_nl").crossJoin(spark.range(0, shares, 1, shares).select(F.col("id").cast("int").alias("share")))

        def add(batches):
            held: dict[int, np.ndarray] = {}
            for piece, share, bins, label in _pieces(batches, kind, width, classes):
                prepared = fn(piece, bins, label)
                for tree in range(share, rules.trees, shares):
                    sums = prepared(tree)
                    if sums is not None:
                        held[tree] = held[tree] + sums if tree in held else sums.astype(float)
            for tree, sums in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["tree", "sums"])

        def one(tree: int, blobs: list[bytes]) -> list[tuple]:
            return best(tree, sum(np.frombuffer(x) for x in blobs).reshape(-1, rules.sums))

        parts = met.select("piece", "n", "bins", "label", "share").mapInArrow(add, "tree int, sums binary")
        if chunks == 1:
            def alone(batches):
                for b in batches:
                    for tree, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                        yield _split_batch(one(tree, [blob]))
            found = parts.mapInArrow(alone, SPLIT)
        else:
            def together(t: pa.Table) -> pa.Table:
                return _split_batch(one(t.column("tree")[0].as_py(), t.column("sums").to_pylist()), pa.Table)
            tasks = min(rules.trees, 3 * spark.sparkContext.defaultParallelism)
            found = parts.repartition(tasks, "tree").groupBy("tree").applyInArrow(together, SPLIT)
        with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(SEEN)}):
            return [tuple(r) for r in found.collect()]

    if table <= TABLE:
        strides = [math.prod(shape[i + 1:]) for i in range(width)]

        def by_cell(piece, bins, label):
            cell = (bins.astype(np.int64) @ np.array(strides)).astype(np.int32)
            return lambda tree: (lambda at: rules.added(cell[at], table, None, label[at]))(rules.drawn(tree, piece, len(label)))

        return summed(by_cell, 8 * table * rules.sums, lambda tree, sums: _grown(rules, tree, sums, strides, shape))

    nodes = (1 << rules.depth) - 1
    feature, cut = np.zeros((rules.trees, nodes), np.int16 if width < 1 << 15 else np.int32), np.full((rules.trees, nodes), rules.bins, np.int32)
    opened, out = {tree: np.array([0]) for tree in range(rules.trees)}, []
    for level in range(rules.depth):
        first, most = (1 << level) - 1, max(map(len, opened.values()))

        def by_node(piece, bins, label):
            flat = bins.reshape(-1)

            def of(tree):
                if tree not in opened:
                    return None
                mine, slot = opened[tree], np.full(1 << level, -1)
                slot[mine - first] = np.arange(len(mine))
                weight = np.bincount(rules.drawn(tree, piece, len(label)), minlength=len(label))
                row = np.flatnonzero(weight)
                base, node = row * width, np.zeros(len(row), np.int64)
                for _ in range(level):              # what reached a leaf goes on to nodes that are not open
                    node = 2 * node + 1 + (flat[base + feature[tree].take(node)] > cut[tree].take(node))
                s = slot.take(node - first)
                if (s < 0).any():
                    live = s >= 0
                    row, base, s = row[live], base[live], s[live]
                looked, w, told = rules.subsets(tree, level)[mine - first], weight[row].astype(float), label[row]
                size = len(mine) * rules.looked * rules.bins
                sums = np.zeros((len(mine), rules.looked, rules.bins, rules.sums))
                for j in range(rules.looked):
                    code = s * rules.bins + flat[base + looked[:, j].take(s)]
                    sums[:, j] = rules.added(code, size // rules.looked, w, told).reshape(len(mine), rules.bins, rules.sums)
                return sums

            return of

        def split(tree, sums):
            mine = opened[tree]
            return rules.best(sums.reshape(len(mine), rules.looked, rules.bins, rules.sums), mine, rules.subsets(tree, level)[mine - first], tree)

        made = summed(by_node, 8 * most * rules.looked * rules.bins * rules.sums, split)
        out += made
        opened = {}
        for x in made:
            if x[2] >= 0:
                feature[x[0], x[1]], cut[x[0], x[1]] = x[2], x[3]
                opened.setdefault(x[0], []).extend(rules.opened(x))
        opened = {tree: np.sort(np.array(o)) for tree, o in opened.items() if o}
        if not opened:
            break
    return out


def _nodes(tree: int, made: dict[int, tuple], kind: str, edges: list[list[float]]) -> list[tuple]:
    """The rows of a tree in Spark's own order: a node, what is left of it, what is right of it."""
    def says(s):
        return s[1] / s[0] if kind == "variance" else float(np.argmax(s))

    def shrunk(node, s):
        """(sums, None or split, left, right); leaves that say the same are joined."""
        x = made.get(node)
        if x is None or x[2] < 0:
            return s if x is None else x[5], None, None, None
        left, right = shrunk(2 * node + 1, x[6]), shrunk(2 * node + 2, x[7])
        if left[1] is None and right[1] is None and says(left[0]) == says(right[0]):
            return x[5], None, None, None
        return x[5], x, left, right

    rows = []

    def listed(item):
        s, x, left, right = item
        at = len(rows)
        rows.append(None)
        impurity, n = _impurity(kind, np.array(s))
        children = (listed(left), listed(right)) if x else (-1, -1)
        split = (x[2], [edges[x[2]][x[3]]], -1) if x else (-1, [], -1)
        rows[at] = (tree, (at, says(s), float(impurity), list(s), int(n), x[4] if x else -1.0, *children, split))
        return at

    listed(shrunk(0, None))
    return rows


def grow(estimator, data: DataFrame, count: int, bin_edges):
    """The model of a forest over (label, ``features``); ``bin_edges(df, names, bins)`` cuts the features."""
    spark, y = data.sparkSession, estimator.getLabelCol()
    wide = data.select(F.col(y).cast("double").alias("_y"), vector_to_array("features").alias("_a"))
    width = wide.select(F.size("_a")).first()[0]
    names = [f"_x{i}" for i in range(width)]
    rows = wide.select("_y", *[F.col("_a")[i].alias(n) for i, n in enumerate(names)])
    classifies = isinstance(estimator, RandomForestClassifier)
    bad = F.col("_y").isNull() | F.isnan("_y") | (((F.col("_y") < 0) | (F.col("_y") != F.floor("_y"))) if classifies else F.lit(False))
    seen = rows.agg(F.count_if(bad).alias("bad"), F.max("_y").alias("most")).first()
    if seen["bad"] or (classifies and seen["most"] >= 100):
        raise ValueError(f"{seen['bad']} labels are missing or no classes, the greatest is {seen['most']}")
    classes = max(int(seen["most"]) + 1, 2) if classifies else 0
    edges = bin_edges(rows, names, estimator.getMaxBins())
    made: dict[int, dict[int, tuple]] = {}
    for x in splits(estimator, rows, edges, classes, count):
        made.setdefault(x[0], {})[x[1]] = x
    found = [n for tree in range(estimator.getNumTrees()) for n in _nodes(tree, made[tree], estimator.getImpurity(), edges)]
    path = new_path(spark, "forest")
    few = spark.createDataFrame([(float(k % (classes or 2)), Vectors.dense([float(k)] * width)) for k in range(max(classes, 2))], [y, "features"])
    stub = estimator.copy({estimator.maxDepth: 0}).fit(few)
    estimator._copyValues(stub).write().save(path)      # what the writer says of the forest, with the nodes of two rows
    ids, structs = zip(*found)
    kinds = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()),
                       ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                       ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())]))])
    split_names = ("featureIndex", "leftCategoriesOrThreshold", "numCategories")
    named = [dict(zip(("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild"), s), split=dict(zip(split_names, s[8]))) for s in structs]
    table = pa.table({"treeID": pa.array(ids, pa.int32()), "nodeData": pa.array(named, kinds)})
    spark.createDataFrame(table, NODE).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return type(stub).load(path)
