import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brambling.llm import fourrussians as R, lexical as L
from tests.llm.conftest import LONG, clashing

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    of = {}
    for i, t in items:
        of.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in of.items():
        found = []
        for d, c in counted:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in words if w in c)
            if score > 0 and d is not None:
                found.append((-score, d))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


DOCS = [(1, "The CAT sat; the cat ran"), (2, "été Été à la mer"), (3, None), (4, ""), (5, " \n--\t"), (6, "cat"), (7, "cat"), (7, "a dog, a cat & a_b x2y"),
        (None, "cat dog"), (8, LONG), (9, "naïve cat"), (10, "cat" * 3), (11, "\U0001f600 cat\x00dog"), (12, "dog DOG dog")]
ITEMS = [(1, "cat"), (2, "dog été 7"), (3, None), (4, "..."), (2, "cat x2y"), (None, "sat naïve"), (5, "naïve cat W1x1 w2x2"), (6, "nothing"), (7, "a-the-b")]


@pytest.mark.parametrize("bounds", [{}, {"group_bytes": 6}, {"item_pairs": 1}])
def test_search_against_counting_terms(spark, bounds):
    """Also with as many automata as items."""
    docs = clashing(spark.createDataFrame(DOCS, "doc_id long, text string"))
    items = clashing(spark.createDataFrame(ITEMS, "item_id long, text string"))
    for k in (1, 3, 10):
        got = sorted((tuple(r) for r in L.search(docs, items, k, **bounds).collect()), key=str)
        assert got == brute_search(DOCS, ITEMS, k)


def test_search_in_empty_tables(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.filter("text is null"), items)):
        out = L.search(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_ties_go_to_the_least_id_across_tasks(spark):
    docs = spark.createDataFrame([(k, "same words here") for k in range(60, 0, -1)] + [(k, "other") for k in range(100, 140)], "doc_id long, text string").repartition(7)
    got = [(r["doc_id"], r["rank"]) for r in L.search(docs, spark.createDataFrame([(1, "words")], "item_id long, text string")).orderBy("rank").collect()]
    assert got == [(k, k) for k in range(1, 11)]


def test_automaton_finds_whole_terms_side_by_side():
    a = L.Automaton([b"ab", b"b", b"\xc3\xa9"])
    assert a.count(L.spaced("AB b ab,b;abb é eé éé".encode())) == {0: 2, 1: 2, 2: 1}
    assert L.Automaton([]).count(b" a ") == {}


def test_query_against_counting_terms(spark):
    from brambling.llm.queries import QUERIES
    root = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{root}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_automaton_search"](spark, root).collect()), key=str)
    assert got == brute_search(docs, items)


# ---- hard negatives ----

def brute_negatives(data, is_anchor, positives=5, negatives=5, low=80):
    """From Python's whole numbers."""
    rows = []
    for i, label, v in data:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) or abs(x) >= 65536 for x in v):
            continue
        rows.append((i, label, [math.floor(256 * x) for x in v]))
    out = []
    for i, label, q in rows:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, other)), j, lab) for j, lab, other in rows if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fit)]
    return sorted(out)


def mined(spark, data, kind="float", every=3, **options):
    df = clashing(spark.createDataFrame(data, f"vec_id long, lab int, embedding array<{kind}>"))
    out = R.hard_negatives(df, F.col("vec_id") % every == 0, label="lab", **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def test_scores_are_inner_products():
    rng = np.random.default_rng(3)
    for d, most in ((1, 2), (8, 300), (13, 1 << 24), (64, 200)):
        a, c = rng.integers(-most, most, (9, d)), rng.integers(-most, most, (50, d))
        assert np.array_equal(R.scores(R.subset_sums(a), R.planes(c)), a @ c.T)
    assert np.array_equal(R.scores(R.subset_sums(np.zeros((2, 8), int)), R.planes(np.zeros((3, 8), int))), np.zeros((2, 3)))


def test_negatives_against_sorting_all_scores(spark):
    rng = np.random.default_rng(4)
    data = [(i, int(rng.integers(0, 4)) if i % 5 else 1, [float(np.float32(x)) for x in rng.normal(size=10) / 3 + 0.3]) for i in range(150)]
    data += [(i + 150, data[i][1], data[i][2]) for i in range(20)]            # equal scores
    assert mined(spark, data) == brute_negatives(data, lambda i: i % 3 == 0)
    some = mined(spark, data, positives=2, negatives=3, low=95)
    assert some == brute_negatives(data, lambda i: i % 3 == 0, 2, 3, 95) and some


def test_negatives_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "ANCHORS", 3)
    rng = np.random.default_rng(5)
    data = [(i, int(i % 3 > 0), [float(x) for x in rng.normal(size=7) + 0.5]) for i in range(200)]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>").repartition(5)
    monkeypatch.setattr(R.index, "__defaults__", (16,))
    got = sorted(tuple(r) for r in R.hard_negatives(df, F.col("vec_id") % 4 == 0).collect())
    assert got == brute_negatives(data, lambda i: i % 4 == 0)


def test_rows_that_take_no_part(spark):
    ones = [1.0, 2.0, 3.0]
    data = [(0, 1, ones), (None, 1, ones), (1, None, ones), (2, 1, None), (3, 1, [1.0, None, 3.0]), (4, 1, [float("nan"), 1.0, 1.0]), (5, 1, [float("inf"), 1.0, 1.0]),
            (6, 1, ones[:2]), (7, 2, [1.0, 2.0, 2.5]), (7, 2, [1.0, 2.0, 2.5]), (8, 2, []), (9, 2, [70000.0, 1.0, 1.0]), (10, 1, [0.9, 2.0, 2.9]), (12, 3, [-1.0, -2.0, -3.0]), (15, 3, ones)]
    got = mined(spark, data, "double")
    assert got == brute_negatives(data, lambda i: i % 3 == 0) and got
    assert mined(spark, data[:1], "double") == [] and mined(spark, [], "double") == []


def test_negatives_query_against_sorting_all_scores(spark):
    from brambling.llm.queries import QUERIES
    root = "/root/testdata/sf0.001"
    data = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"]) for r in spark.read.parquet(f"{root}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_four_russians"](spark, root).collect())
    assert got == brute_negatives(data, lambda i: i % 100 == 0) and got
