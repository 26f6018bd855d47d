import random
import re

import numpy as np
import pytest

from brambling.llm import jaccard
from brambling.llm.components import components
from brambling.llm.queries import QUERIES
from tests.llm.conftest import ODD, ROOT, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = WORD.findall((text or "").translate(UPPER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(docs):
    """(size, component id) by comparing all pairs; ``docs`` are (id, text)."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return [(d, len(s), least.get(top(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def compare(df, docs):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(df)), key=key)
    assert got == sorted(brute(docs), key=key)


def test_query_against_all_pairs(spark, documents):
    compare(QUERIES["op5_fragment_join"](spark, ROOT), [(r.doc_id, r.text) for r in documents.collect()])


def test_families_of_near_copies(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefg", k=4))
    passage = [word() for _ in range(60)]
    docs, d = [], 0
    for family in range(6):
        original = [word() for _ in range(rng.choice([7, 40, 160]))]
        for _ in range(12):
            copy = list(original)
            for _ in range(rng.randrange(0, max(1, len(original) // 25) + 1)):
                copy[rng.randrange(len(copy))] = word()
            docs.append((d, " ".join(copy).upper() if rng.random() < .3 else "  ".join(copy)))
            d += 1
    docs += [(1000 + i, " ".join(passage + [word() for _ in range(rng.choice([10, 15, 20, 30]))])) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    compare(jaccard.near_duplicates(df), docs)


def test_cells_alone_find_every_link(spark, monkeypatch):
    """No hub rounds: all links come out of crowded buckets cut into cells of 7 members."""
    monkeypatch.setattr(jaccard, "HUB_ROUNDS", 0)
    monkeypatch.setattr(jaccard.link_classes, "__defaults__", (75, 4, 7))
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    original, docs = [word() for _ in range(50)], []
    for d in range(45):
        copy = list(original)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(50)] = word()
        docs.append((d, " ".join(copy)))
    docs += [(100 + i, " ".join([word() for _ in range(30)])) for i in range(10)]
    compare(jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")), docs)


def test_a_common_line_makes_few_candidates(spark, monkeypatch):
    """Texts that share a line, but do not link, are not verified pair by pair; a family of near copies is linear."""
    rng = random.Random(10)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    line, original = [word() for _ in range(14)], [word() for _ in range(60)]
    docs = [(i, " ".join(line + [word() for _ in range(9)])) for i in range(120)]
    docs += [(500 + i, " ".join([*original[:k], word(), *original[k:]])) for i, k in enumerate(range(0, 60))]
    seen, verify = [], jaccard.verify
    monkeypatch.setattr(jaccard, "verify", lambda pairs, *a: (seen.append(pairs.count()), verify(pairs, *a))[1])
    compare(jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")), docs)
    assert sum(seen) <= 4 * len(docs)


def test_bitmaps_never_differ_in_more_bits_than_sets_in_ngrams():
    rng = np.random.default_rng(1)
    for n in (1, 5, 300, 4000):
        x = rng.integers(0, 2**64, n, np.uint64)
        y = np.unique(np.concatenate([x[:n // 2], rng.integers(0, 2**64, n, np.uint64)]))
        differ = int(np.bitwise_count((jaccard.bitmap(x) ^ jaccard.bitmap(y)).view(np.uint64)).sum())
        assert differ <= len(np.setxor1d(x, y)) and jaccard.bitmap(x).shape == (jaccard.BITS // 64,)


def test_odd_rows(odd, nothing):
    compare(jaccard.near_duplicates(odd), [(r[0], r[1]) for r in ODD])
    assert jaccard.near_duplicates(nothing).count() == 0


def test_no_text_is_shuffled(spark, monkeypatch):
    """Texts are picked where they are read, also where nothing is small enough to be broadcast unasked."""
    rng = random.Random(11)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(rng.choice([3, 30])))
    same = text()
    docs = [(i if i % 50 else None, same if i % 20 == 0 else text()) for i in range(300)]
    docs += [(7, same), (8, docs[9][1] + " more"), (9, None), (10, " ")]
    plans, settle = [], jaccard.settle
    monkeypatch.setattr(jaccard, "settle", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), settle(df))[1])
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("text", "full text")
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        compare(jaccard.near_duplicates(df, text="full text"), docs)
    finally:
        spark.conf.set(key, before)
    assert any("grams" in p for p in plans)
    for p in plans:
        lines = p.splitlines()
        for at, line in enumerate(lines):
            if re.search(r"(?<!Broadcast)Exchange ", line):
                below = next(x for x in lines[at + 1:] if "Sort " not in x)
                assert not re.search(r"text#|full text", below), below


def test_a_crowded_bitmap_only_lets_more_texts_through(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "ID_BITS", 4)
    rng = random.Random(12)
    original = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(40)]
    docs = [(i, " ".join(original[i % 3:] if i % 2 else original[i // 3:])) for i in range(40)]
    docs += [(100 + i, " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(20))) for i in range(20)]
    compare(jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")), docs)


def test_one_of_each_group_stays(odd, nothing):
    kept = jaccard.deduplicate(odd)
    assert kept.columns == odd.columns
    texts = [(r["doc_id"], r["text"]) for r in rows(kept)]
    ids = sorted(i for i, _ in texts if i is not None)
    assert ids == [1, 2, 3, 4, 5, 6, 8, 8, 10] and sum(i is None for i, _ in texts) == 1
    assert jaccard.deduplicate(nothing).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    want = {}
    for a, b in edges:
        if a != b:
            for x in (a, b):
                want[x] = 200 if x >= 200 else 0
    assert {r["node"]: r["component"] for r in rows(components(df), "node")} == want
