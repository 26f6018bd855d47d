import numpy as np
import pyspark.ml.feature
import pytest

from brambling.operators import corpus, skipgram


def planted(rng, texts, words=12, length=30):
    """Texts of one of three topics each; a topic has words of its own."""
    name = lambda topic, w: "abc"[topic] + "".join(chr(97 + int(d)) for d in f"{w:02d}")
    return [(" ".join(name(k % 3, w) for w in rng.integers(0, words, length)),) for k in range(texts)]


def nearest_share(got):
    words = sorted(got)
    v = np.array([got[w] for w in words])
    like = (v / np.linalg.norm(v, axis=1)[:, None]) @ (v / np.linalg.norm(v, axis=1)[:, None]).T
    np.fill_diagonal(like, -2)
    return np.mean([words[j][0] == words[i][0] for i, j in enumerate(like.argmax(1))])


@pytest.mark.parametrize("share", [4_000_000, 8_000])
def test_words_of_a_topic_lie_together(spark, monkeypatch, share):
    """In one group and in several, whose tables are averaged; no model is fitted on the driver."""
    def fit(*a):
        raise AssertionError("the whole vocabulary on the driver")
    monkeypatch.setattr(pyspark.ml.feature.Word2Vec, "_fit", fit)
    monkeypatch.setattr(corpus, "TRAINED", share)
    rows = [*planted(np.random.default_rng(1), 450), (None,), ("",), ("abb seldom seldom",)]
    df = spark.createDataFrame(rows, "text string")
    found = corpus.train_word_vectors(df, "text", size=12, window=5, min_count=2)
    got = {r.word: r.vector for r in found.collect()}
    assert len(got) == 37 == found.count() and {len(v) for v in got.values()} == {12}
    assert np.isfinite(np.array(list(got.values()))).all()
    got.pop("seldom")
    assert nearest_share(got) > 0.95
    assert corpus.train_word_vectors(df.filter("text is null"), "text", size=3).count() == 0


def test_windows_end_with_their_text():
    """Single words of many texts tell nothing of one another: only negatives move, and nothing is pulled together."""
    inner, outer = np.full((2, 4), .1, np.float32), np.zeros((2, 4), np.float32)
    before = inner.copy()
    skipgram.train(np.arange(100) % 2, np.arange(100), inner, outer, 5, (.025, .01), np.random.default_rng(0))
    assert (inner == before).all() and (outer == 0).all()
