import numpy as np
import pytest
from pyspark.sql import functions as F

from brambling.llm import crosspoly as C
from tests.llm.conftest import clashing, rows

ROOT = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(data, threshold=C.THRESHOLD):
    """(n_links, component_id) per row by all pairs."""
    usable = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) for _, v in data]
    n = len(data)
    group = list(range(n))
    links = [0] * n

    def root(u):
        while group[u] != u:
            u = group[u]
        return u
    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and len(data[i][1]) == len(data[j][1]):
                if C.exact_cosine(np.array(data[i][1], float), np.array(data[j][1], float)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    group[root(i)] = root(j)
    least = {}
    for i in range(n):
        if data[i][0] is not None:
            least[root(i)] = min(least.get(root(i), data[i][0]), data[i][0])
    return [(links[i], least.get(root(i))) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k % 3) for k, (i, v) in enumerate(data)], SCHEMA)


def families(rng, d, sizes, spread, loose):
    out = []
    for size in sizes:
        centre = rng.normal(size=d)
        out += [centre + spread * rng.normal(size=d) for _ in range(size)]
    return [np.float32(v) for v in [*out, *rng.normal(size=(loose, d))]]


def check(spark, data, **options):
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in C.near_vectors(frame(spark, data), **options).collect())
    want = sorted((i, n, c, i == c) for (i, _), (n, c) in zip(data, brute([(i, np.float32(v).tolist()) for i, v in data])))
    assert got == want


def test_families_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    check(spark, list(enumerate(families(rng, 64, [40, 7, 2, 2], 0.15, 120))))
    check(spark, list(enumerate(families(rng, 10, [15, 3], 0.12, 60))))      # not a power of two


def test_hot_buckets_are_cut_into_cells(spark):
    """A cell of 5 vectors: one family fills many cells, and every link still counts once."""
    rng = np.random.default_rng(6)
    vectors = families(rng, 16, [60, 9], 0.08, 30)
    check(spark, list(enumerate([*vectors, *vectors[:20]])), cell=5)


def test_a_table_counts_only_what_no_earlier_one_met():
    rng = np.random.default_rng(7)
    x = C.unit(rng.normal(size=(300, 32)))
    first, again = C.codes(x, 0, 2, 3, 1), C.codes(x, 0, 2, 3, 1)
    assert np.array_equal(first, again) and first.shape == (300, 4)
    assert all(len(set(row)) == 4 for row in first.tolist())
    assert C.meet(first, first).all()


def test_hadamard_is_the_matrix_product():
    h = np.array([[1.0]])
    while len(h) < 16:
        h = np.block([[h, h], [h, -h]])
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose(C.hadamard(x), x @ h)


@pytest.mark.parametrize("n", [100, 100_000, 10_000_000])
def test_plan_finds_pairs_at_the_threshold(n):
    """On other pairs than those the plan was made with."""
    width, tables = C.plan(n, 64)
    rng = np.random.default_rng(99)
    x, z = C.unit(rng.normal(size=(3_000, 64))), rng.normal(size=(3_000, 64))
    z = C.unit(z - np.einsum("ij,ij->i", x, z)[:, None] * x)
    y = C.THRESHOLD * x + np.sqrt(1 - C.THRESHOLD ** 2) * z
    found = np.zeros(3_000, bool)
    for t in range(tables):
        found |= C.meet(C.codes(x, t, width, C.PROBES, 1), C.codes(y, t, width, C.PROBES, 1))
    assert found.mean() >= 0.99


def test_rows_that_cannot_link(spark):
    base = [1.0] * 8
    data = [(1, None), (2, []), (3, [0.0] * 8), (4, [None] + base[1:]), (5, [float("nan")] + base[1:]), (6, [float("inf")] + base[1:]),
            (7, base), (7, base), (None, base), (None, [-1.0] * 8), (8, [2.0] * 8), (9, base[:4]), (10, [-x for x in base[:4]]), (11, [1e-30] * 8)]
    given = clashing(frame(spark, data))
    got = rows(C.near_vectors(given), "vec_id", "n_links")
    alone = [r for r in got if r["n_links"] == 0]
    assert {r["vec_id"] for r in alone} == {None, 1, 2, 3, 4, 5, 6, 9, 10} and len(alone) == 9
    assert [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got if r["n_links"]] == [
        (None, 4, 7, False), (7, 4, 7, True), (7, 4, 7, True), (8, 4, 7, False), (11, 4, 7, False)]
    empty = C.near_vectors(given.limit(0))
    assert empty.count() == 0 and empty.columns == ["vec_id", "n_links", "component_id", "kept"]


def test_double_vectors_and_text_ids(spark):
    df = spark.createDataFrame([("b", [1e200, 1e200]), ("a", [1.0, 1.0 + 1e-12]), ("c", [1.0, -1.0])], "name string, v array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in C.near_vectors(df, id="name", vector="v").collect()}
    assert got == {"a": (1, "a"), "b": (1, "a"), "c": (0, "c")}


def test_query_against_all_pairs(spark):
    from brambling.llm.queries import QUERIES
    pdf = spark.read.parquet(f"{ROOT}/embeddings.parquet").select("vec_id", F.col("embedding")).toPandas()
    x = np.stack(pdf.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= C.THRESHOLD).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in QUERIES["op11_cross_polytope"](spark, ROOT).collect()}
    assert got == dict(zip(pdf.vec_id.tolist(), links.tolist()))
