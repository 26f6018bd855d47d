import math
from collections import defaultdict

import numpy as np
import pytest

from brambling.operators import similar as S


def brute(rows, k, cosine):
    vectors = defaultdict(lambda: defaultdict(list))
    for user, item, q in rows:
        if user is not None and item is not None and (q is not None or not cosine):
            vectors[item][user].append(q)
    out = []
    mean = {i: {u: sum(v) / len(v) for u, v in us.items()} if cosine else dict.fromkeys(us, 1.0) for i, us in vectors.items()}
    norm = {i: math.sqrt(sum(v * v for v in us.values())) for i, us in mean.items()}
    for a in mean:
        found = []
        for b in mean:
            common = set(mean[a]) & set(mean[b])
            if a != b and common:
                dot = sum(mean[a][u] * mean[b][u] for u in common)
                s = dot / (norm[a] * norm[b]) if cosine else len(common) / (len(mean[a]) + len(mean[b]) - len(common))
                found.append((-round(s, 9), b, len(common)))
        out += [(a, b, r + 1, n, round(-s, 6)) for r, (s, b, n) in enumerate(sorted(found)[:k])]
    return sorted(out)


def shop(rng, users=60, items=40, n=900, crowd=0.3):
    """One user holds a third of all rows, one item is in most baskets."""
    rows = []
    for _ in range(n):
        user = 0 if rng.random() < crowd else int(rng.integers(1, users))
        item = 7 if rng.random() < .1 else int(items * rng.random() ** 2)
        rows.append((user, item, float(rng.integers(1, 50))))
    return rows


@pytest.mark.parametrize("cosine", [True, False])
@pytest.mark.parametrize("k", [1, 4])
def test_every_item_against_all_pairs(spark, cosine, k):
    rows = shop(np.random.default_rng(k))
    rows += [(None, 3, 1.0), (1, None, 2.0), (200, 900, 5.0), (201, 901, 1.0), (201, 902, 1.0), (202, 903, None)]      # nulls; an item alone; two that only have each other
    df = spark.createDataFrame(rows, "user long, item long, quantity double")
    got = sorted((r["seed"], r["item"], r["rank"], r["users"], round(r["similarity"], 6)) for r in S.similar_items(df, k, cosine).collect())
    assert got == brute(rows, k, cosine)


def test_a_weak_floor_loses_nothing(spark, monkeypatch):
    """With hardly any promising partners the search still is whole."""
    monkeypatch.setattr(S, "SEED_USERS", 1)
    monkeypatch.setattr(S, "SEED_ITEMS", 1)
    rows = shop(np.random.default_rng(9), n=400)
    df = spark.createDataFrame(rows, "user long, item long, quantity double")
    got = sorted((r["seed"], r["item"], r["rank"], r["users"], round(r["similarity"], 6)) for r in S.similar_items(df, 3).collect())
    assert got == brute(rows, 3, True)
    assert S.similar_items(df.limit(0)).count() == 0


@pytest.mark.parametrize("cosine", [True, False])
@pytest.mark.parametrize("light", [0, 400, 100_000])
def test_items_that_meet_few_rows_are_added_up_without_pairs(spark, monkeypatch, cosine, light):
    """Light, heavy and mixed tables give the same; ids may be wide or negative, equal scores many, batches small."""
    for name, value in (("LIGHT", light), ("PAIRS", 400), ("SENT", 500)):
        monkeypatch.setattr(S, name, value)
    wide = {3: 1 << 50, 4: -5, 7: -(1 << 40)}
    rows = [(u, wide.get(i, i), q) for u, i, q in shop(np.random.default_rng(4), n=500, crowd=.1)] + [(1000 + u, 2000 + i, 2.0) for u in range(3) for i in range(9)]
    df = spark.createDataFrame(rows, "user long, item long, quantity double")
    got = sorted((r["seed"], r["item"], r["rank"], r["users"], round(r["similarity"], 6)) for r in S.similar_items(df, 3, cosine).collect())
    assert got == brute(rows, 3, cosine)


@pytest.mark.parametrize("cosine", [True, False])
def test_no_candidate_is_written_for_light_items(spark, monkeypatch, cosine):
    """Tables that are written grow with the entries, not with the pairs."""
    written, settle = [], S.settle
    monkeypatch.setattr(S, "settle", lambda df: written.append(settle(df)) or written[-1])
    rows = [(u, i, 1.0 + i % 3) for u in range(4) for i in range(200)]
    df = spark.createDataFrame(rows, "user long, item long, quantity double")
    assert S.similar_items(df, 2, cosine).count() == 400
    assert max(w.count() for w in written) <= len(rows)
