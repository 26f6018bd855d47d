import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from brambling.llm import rules
from brambling.llm.queries import QUERIES
from tests.llm.conftest import ODD, ROOT, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    text = text or ""
    w = WORD.findall(text)
    windows = list(zip(w, w[1:], w[2:]))
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def failed(s):
    return s[0] < 50 or 100 * s[4] > 50 * s[0]


def test_query_statistics_and_verdicts(spark, documents):
    got = {r["doc_id"]: r for r in rows(QUERIES["op3_decision_list"](spark, ROOT))}
    for d in documents.collect():
        s, r = statistics(d.text), got[d.doc_id]
        assert tuple(r[c] for c in rules.STATISTICS) == s and r["base_failed"] == failed(s)
        assert r["kept"] == (not failed(s) and r["rule"] == 0)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect()}
    clean = [i for i, q in labels.items() if q == 1 and not got[i]["base_failed"]]
    assert all(got[i]["kept"] for i in clean)


def test_odd_rows(spark, odd, nothing):
    repeated = "a b c " * 40 + "x y z"
    more = odd.unionByName(odd.limit(1).withColumn("text", F.lit(repeated)).withColumn("doc_id", F.lit(77).cast("long")))
    got = rows(rules.judge(more, []).select("row.doc_id", "row.text", *rules.STATISTICS, "base_failed", "kept"))
    assert len(got) == len(ODD) + 1
    for r in got:
        assert tuple(r[c] for c in rules.STATISTICS) == statistics(r["text"])
    assert rules.judge(nothing, []).count() == 0 and rules.keep(nothing, []).columns == nothing.columns
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rules.fit(odd, none) == [] and rules.fit(nothing, none) == []
    kept = rules.keep(more, [])
    assert {r["doc_id"] for r in rows(kept)} == {r["doc_id"] for r in got if r["kept"]}


def test_windows_of_one_hash_are_told_apart_by_their_words(spark, monkeypatch):
    """Other windows of the same hash stand between equal ones."""
    monkeypatch.setattr(rules, "window_hash", lambda words, i: F.lit(7).cast("long"))
    rng = np.random.default_rng(2)
    texts = ["a b c x y z a b c", *[" ".join(rng.choice(list("abcd"), n)) for n in (4, 9, 30, 80)], "p q r " * 3 + "s"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = rows(rules.with_statistics(df).select("row.doc_id", "n_repeat_words"))
    assert [r["n_repeat_words"] for r in got] == [statistics(t)[4] for t in texts]


def test_learned_conjunction():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(3000), "b": rng.random(3000)}
    bad = (x["a"] > 0.6) & (x["b"] <= 0.3)
    found = rules.learn(x, bad)
    hit = np.zeros(3000, bool)
    for rule in found:
        hit |= rules._covers(rule, x, 3000)
    assert found and (hit & ~bad).sum() <= 0.05 * hit.sum() and (hit & bad).sum() > 0.95 * bad.sum()
    assert rules.learn({k: v[:0] for k, v in x.items()}, bad[:0]) == []
    assert rules.learn(x, rng.random(3000) < 0.1) == []      # nothing to learn from noise


def test_rules_become_ordered_conditions(spark):
    first = (rules.Literal("symbols_per_word", True, 0.5),)
    second = (rules.Literal("mean_word", False, 4.0), rules.Literal("n_words", True, 10.0))
    df = spark.createDataFrame([(1, 100, 300, 90, 0, 0), (2, 100, 300, 0, 0, 0), (3, 5, 10, 0, 0, 0), (4, 100, 600, 0, 0, 0)], "id int, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    assert [r[0] for r in df.orderBy("id").select(rules.fired([first, second])).collect()] == [1, 2, 0, 0]
