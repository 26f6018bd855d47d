import numpy as np
import pytest
from pyspark.sql import functions as F

from brambling.operators import corpus
from tests.test_word_vectors import nearest_share, planted


def test_first_vectors_are_those_of_the_hash(spark):
    words = spark.createDataFrame([("a",), ("word",), ("étude",), ("",)], "word string")
    start = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: ((F.pmod(F.xxhash64("word", i), F.lit(1_000_003)) / 1_000_003 - 0.5) / 7).cast("float"))
    rows = words.select(F.xxhash64("word").alias("h"), start.alias("v")).collect()
    assert (corpus._start(np.array([r.h for r in rows]), 7) == np.array([r.v for r in rows], np.float32)).all()


@pytest.mark.parametrize("share", [4_000_000, 8_000])
def test_blocks_cross_between_parts_and_groups(spark, monkeypatch, share):
    """A word's vector never is a row of its own on the way: rows grow with parts and groups, whatever the number of words;
    only the last table is left of those that epochs write."""
    monkeypatch.setattr(corpus, "TRAINED", share)
    monkeypatch.setattr(corpus, "PART", 500)
    written, settle, gone, remove = [], corpus.settle, [], corpus.remove
    monkeypatch.setattr(corpus, "settle", lambda df: written.append(settle(df)) or written[-1])
    monkeypatch.setattr(corpus, "remove", lambda spark, path: gone.append(path) or remove(spark, path))
    df = spark.createDataFrame(planted(np.random.default_rng(1), 450), "text string")
    found = corpus.train_word_vectors(df, "text", size=12, window=5, epochs=4)
    got = {r.word: r.vector for r in found.collect()}
    assert len(got) == 36 and nearest_share(got) > 0.95
    tables = [w for w in written if w.columns == ["p", "known", "vectors"]]
    assert len(tables) == 5 and len(gone) == 4
    assert written[-1].count() <= 8 and not any("vector" in w.columns or "inner" in w.columns for w in written)
