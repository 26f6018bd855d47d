from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brambling.functions import text as T
from brambling.operators import corpus, graph, recommend, search
from brambling.operators.stem import stem_words
from brambling.plans import hotel

# published examples of the suffix rules
STEMS = {"caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster", "motoring": "motor",
         "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "falling": "fall", "hissing": "hiss",
         "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "digitizer": "digit",
         "radically": "radic", "vietnamization": "vietnam", "operator": "oper", "feudalism": "feudal", "hopefulness": "hope",
         "sensitivity": "sensit", "triplicate": "triplic", "formative": "form", "electrical": "electr", "goodness": "good",
         "revival": "reviv", "allowance": "allow", "adjustable": "adjust", "replacement": "replac", "adoption": "adopt", "effective": "effect",
         "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "is": "is", "generalizations": "gener"}


def test_stems(spark):
    got = {r.word: r.stem for r in stem_words(spark.createDataFrame([(w,) for w in STEMS], "word string")).collect()}
    assert got == STEMS


def test_stem_and_lemma_keep_the_order(spark):
    df = spark.createDataFrame([(1, ["hopping", "cats", "sky", "cats"]), (2, [])], "id int, tokens array<string>")
    assert {r.id: r.tokens for r in corpus.stem(df, "id", "tokens").collect()} == {1: ["hop", "cat", "sky", "cat"], 2: []}
    lemmas = spark.createDataFrame([("cats", "feline")], "word string, lemma string")
    assert {r.id: r.tokens for r in corpus.lemmatize(df, "id", "tokens", lemmas).collect()} == {1: ["hopping", "feline", "sky", "feline"], 2: []}


def test_language_is_found(spark):
    rows = [(1, "the cat sat on the mat with the other cats", "en"), (2, "der hund und die katze schlafen nicht", "de"),
            (3, "that this then there these those", "en"), (4, "ich nicht auch noch durch nacht", "de")]
    df = spark.createDataFrame(rows, "id int, text string, lang string")
    model = corpus.fit_language(df, "id", "text", "lang", ["de", "en"])
    new = spark.createDataFrame([(9, "the other cat there"), (10, "nacht und hund"), (11, "123 !"), (12, None)], "id int, text string")
    assert {r.id: r.detected for r in corpus.detect_language(new, "id", "text", model, ["de", "en"]).collect()} == {9: "en", 10: "de", 11: None, 12: None}


def test_embedding_counts_known_words_only(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 4.0])], "word string, vector array<double>")
    df = spark.createDataFrame([(1, "a a b zzz"), (2, "zzz")], "id int, text string")
    out = {r.id: r.embedding for r in corpus.doc_embedding(df, "id", "text", vectors).collect()}
    assert out[1] == pytest.approx([2 / 3, 4 / 3]) and out[2] is None


CLAUSES = [("h1", 1, "the pool is clean and big"), ("h1", 2, "breakfast was cold"), ("h2", 3, "clean room near the pool bar"), ("h3", 4, "noise all night"),
           ("h2", 5, "pool pool pool"), ("h4", 6, "nothing to say")]


def test_search_against_plain_python(spark):
    df = spark.createDataFrame(CLAUSES, "listing string, id int, text string")
    queries, weights = ["clean pool!", "night noise", "breakfast", "bar", "xyz"], [1.0, .5, .5, 2.0, 1.0]
    total, words = {}, {i: set(T_words(t)) for _, i, t in CLAUSES}
    best = {}
    for c, q in enumerate(queries):
        wanted = set(q.replace("!", "").split())
        rows = [(l, i, t) for l, i, t in CLAUSES if any(w in t for w in wanted)]
        vocab = set().union(*[words[i] for _, i, _ in rows]) if rows else set()
        for l, i, _ in rows:
            score = len(wanted & words[i]) / len(vocab)
            best[l, c] = max(best.get((l, c), 0), score)
    for l in {l for l, _, _ in CLAUSES}:
        total[l] = sum(best.get((l, c), 0) * w for c, w in enumerate(weights)) / 5
    ranked, evidence = hotel.rank_listings(df, "listing", "id", "text", queries, weights)
    out = ranked.collect()
    assert {r.listing: r.total for r in out} == pytest.approx(total)
    assert [r.total for r in out] == sorted(total.values(), reverse=True)
    proof = {(r.listing, r.criterion): r.evidence for r in evidence.collect()}
    assert proof["h2", 0] == "clean room near the pool bar" and ("h4", 0) not in proof


def T_words(text):
    return [w for w in text.split() if len(w) > 1]


def test_vocabulary_limit_is_by_frequency(spark):
    df = spark.createDataFrame([(0, "aa bb cc", ["aa", "cc"]), (0, "aa bb", ["aa", "cc"])], "criterion int, text string, wanted array<string>")
    rows = search.hamming_score(df, "text", max_terms=2).collect()
    assert sorted(r.score for r in rows) == [0.5, 0.5]      # vocabulary aa, bb: cc no longer counts


def test_search_cap_keeps_the_best_rows(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x y"), (3, "x")], "id int, text string")
    assert [r.id for r in search.candidate_search(df, "x y", F.col("text"), ["id"], cap=2).collect()] == [2, 1]


@pytest.fixture(scope="module")
def sales(spark):
    rng = np.random.default_rng(8)
    rows = {(int(u), int(i)): float(q) for u, i, q in zip(rng.integers(0, 12, 150), rng.integers(0, 15, 150), rng.integers(1, 9, 150))}
    flat = [(u, i, q) for (u, i), q in rows.items()]
    matrix = np.zeros((15, 12))
    for (u, i), q in rows.items():
        matrix[i, u] = q
    return matrix, spark.createDataFrame(flat, "user bigint, item bigint, quantity double")


def test_recommendation_against_the_matrix(sales, spark):
    matrix, df = sales
    norm = np.linalg.norm(matrix, axis=1)
    cosine = matrix @ matrix.T / np.outer(norm, norm)
    owned = np.nonzero(matrix[:, 3])[0]
    score = cosine[owned].sum(0)
    fresh = sorted((i for i in range(15) if i not in owned and norm[i]), key=lambda i: (-round(score[i], 9), i))[:4]
    out = recommend.recommend(df, 3, 4).collect()
    assert [r["item"] for r in out] == fresh and np.allclose([r.score for r in out], score[fresh])
    items = spark.createDataFrame([(i, f"n{i}") for i in range(15)], "item bigint, name string")
    near = recommend.item_similarity(df, 2, items, 3).collect()
    assert near[0]["item"] == 2 and np.allclose([r.similarity for r in near], np.sort(cosine[2])[::-1][:3])
    seeds = spark.createDataFrame([(2,)], "seed bigint")
    has = matrix > 0
    for r in recommend.jaccard_to(df, seeds).collect():
        assert r.jaccard == pytest.approx((has[2] & has[r["item"]]).sum() / (has[2] | has[r["item"]]).sum())


def test_pairs_of_a_clause(spark):
    lexicon = spark.createDataFrame([("staff", "connector"), ("friendly", "adjective"), ("room", "noun"), ("bath", "compound"), ("small", "adjective")],
                                    "word string, tag string")
    df = spark.createDataFrame([(1, "friendly staff and small bath room".split())], "id int, tokens array<string>")
    tagged = graph.tag_tokens(df, ["id"], "tokens", lexicon)
    pairs = {(r.obj1, r.obj2) for r in graph.adjacent_pairs(tagged, ["id"]).collect()}
    assert pairs == {("staff", "friendly"), ("staff", "small"), ("room", "staff"), ("room", "bath"), ("room", "small")}
    near = {(r.subject, r.object) for r in graph.nearest_subject(tagged, ["id"]).collect()}
    assert near == {("staff", "small"), ("staff", "room")}


def test_weights_count_before_naming(spark):
    pairs = spark.createDataFrame([("rooms", "Big"), ("room", "big"), ("rooms", "na"), ("bath", "rooms")], "obj1 string, obj2 string")
    lemmas = spark.createDataFrame([("rooms", "room")], "word string, lemma string")
    got = {(r.obj1, r.obj2): r.weight for r in graph.weighted_edges(pairs, lemmas).collect()}
    assert got == {("room", "big"): 2, ("bath", "room"): 1}


def test_degree_counts_neighbours_once_and_loops_twice(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "a", 1), ("a", "c", 1), ("d", "d", 1), ("e", "f", 1)], "obj1 string, obj2 string, weight int")
    kept = {(r.obj1, r.obj2) for r in graph.degree_filter(edges, 1).collect()}
    assert kept == {("a", "b"), ("b", "a"), ("a", "c"), ("d", "d")}


def test_a_table_of_words_is_met_once_per_group_and_word(spark, monkeypatch):
    """A frequent word is one row of a group, however often it stands there; small groups and slices change no result."""
    rows = [(i % 40, "the the pool Pool " * 5 + f"w{'abcdefgh'[i % 8]}") for i in range(80)] + [(None, "the"), (99, None), (98, "")]
    df = spark.createDataFrame(rows, "id int, text string")
    monkeypatch.setattr(corpus, "GROUP", 300)
    monkeypatch.setattr(corpus, "CHUNK", 100)
    grouped, needed = corpus.grouped_words(df, ["id"], T.words(F.col("text")))
    assert needed.count() == needed.distinct().count() and needed.filter("word = 'the'").count() == grouped.select("_g").distinct().count() > 4
    vectors = spark.createDataFrame([("the", [1.0, 0.0]), ("pool", [0.0, 3.0]), ("wa", [7.0, 7.0])], "word string, vector array<double>")
    out = {r.id: r.embedding for r in corpus.doc_embedding(df, "id", "text", vectors).collect()}
    assert out[0] == pytest.approx([17 / 21, 37 / 21]) and out[1] == pytest.approx([.5, 1.5])
    assert out[None] is None and out[99] is None and out[98] is None


def test_tags_and_pairs_in_small_groups(spark, monkeypatch):
    lexicon = spark.createDataFrame([("staff", "connector"), ("friendly", "adjective"), ("room", "noun")], "word string, tag string")
    df = spark.createDataFrame([(i, ["friendly", "staff", "and", "room", f"x{i}"]) for i in range(50)] + [(77, ["staff"]), (78, []), (79, ["no"])], "id int, tokens array<string>")
    monkeypatch.setattr(corpus, "GROUP", 60)
    monkeypatch.setattr(corpus, "CHUNK", 40)
    tagged = graph.tag_tokens(df, ["id"], "tokens", lexicon)
    assert "Window" not in graph.adjacent_pairs(tagged, ["id"])._jdf.queryExecution().toString()
    pairs = sorted((r.id, r.obj1, r.obj2) for r in graph.adjacent_pairs(tagged, ["id"]).collect())
    assert pairs == sorted(p for i in range(50) for p in ((i, "staff", "friendly"), (i, "room", "staff")))
    assert graph.nearest_subject(tagged, ["id"]).count() == 50


def test_repeated_words_and_null_components_of_a_vector_table(spark):
    """A word that comes twice counts twice; a null component adds nothing but counts, and is null if there is nothing else."""
    vectors = spark.createDataFrame([("a", [1.0, None]), ("b", [2.0, 4.0]), ("b", [4.0, 0.0]), ("c", None)], "word string, vector array<double>")
    df = spark.createDataFrame([(1, "a b"), (2, "a a"), (3, "b c")], "id int, text string")
    out = {r.id: r.embedding for r in corpus.doc_embedding(df, "id", "text", vectors.orderBy("word")).collect()}
    assert out[1] == pytest.approx([7 / 3, 4 / 3]) and out[2] == [1.0, None] and out[3] == pytest.approx([2.0, 4 / 3])


def test_rows_with_equal_keys_are_one_clause(spark):
    lexicon = spark.createDataFrame([("staff", "connector"), ("nice", "adjective")], "word string, tag string")
    df = spark.createDataFrame([(None, ["staff", "x", "x", "nice"])] * 2 + [(2, ["staff", "x", "nice"])], "id int, tokens array<string>")
    rows = graph.adjacent_pairs(graph.tag_tokens(df, ["id"], "tokens", lexicon), ["id"]).collect()
    assert [tuple(r) for r in rows] == [(2, "staff", "nice")]


ODD_TEXTS = [None, "", " ", "The  the pool-side, 3rd\tRoom's", "a\x1cb \x1f c\x85d\xa0e\x00f", "Ärger über ÇA ÿ \xb5m \xaa\xba ×÷ ß", "".join(map(chr, range(256))),
             "\u212aelvin \u0130stanbul \u03a3\u0391\u03a3 na\u0308h \u2003x\u3000y", "\u65e5\u672c go \U0001f642", "end."]


@pytest.mark.parametrize("rule, kept", [(T.words, corpus.WORDS), (corpus._letters, corpus.LETTERS)])
def test_words_cut_by_bytes_are_those_of_the_column_rule(spark, rule, kept):
    df = spark.createDataFrame([(i % 3 or None, t) for i, t in enumerate(ODD_TEXTS * 2)], "lang int, text string")
    plan = corpus.word_totals(df, ["lang"], "text", rule, kept)
    want = df.select("lang", F.explode(rule(F.col("text"))).alias("word")).groupBy("lang", "word").count()
    assert sorted(map(str, map(tuple, plan.collect()))) == sorted(map(str, map(tuple, want.collect())))
    got = corpus.marked_words(df, ["text"], "text", rule, kept).select("text", F.filter(F.split("_words", corpus.MARK), lambda w: w != "").alias("w"))
    assert Counter((r.text, tuple(r.w)) for r in got.collect()) == Counter((r.text, tuple(r.w or [])) for r in df.select("text", rule(F.col("text")).alias("w")).collect())


def test_words_are_counted_before_they_become_rows(spark):
    """No token of a Latin-1 text becomes a row of its own."""
    df = spark.createDataFrame([("the pool the",), (None,)], "text string")
    assert "Generate" not in corpus.vocabulary(df, "text")._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in corpus.vocabulary(df, "text").collect()} == {("the", 2), ("pool", 1)}


def test_clauses_cut_in_one_pass_are_those_of_the_column_rules(spark):
    long = "one two  three,four five six seven eight nine; ten and eleven twelve thir3teen x y z q r s t. Bad! \n\n  , tail AND the \u212aelvin a b c d e f g"
    odd = [t and t.replace("\x0b", " ") for t in ODD_TEXTS] + [long, long.replace("x", "\xa0\x85\x1c \u00c4"), long.replace("y", "\u2003 \u0130 \u4e2d"), long.replace(" ", "\x0b"), "a?\x1cb. " * 9]
    df = spark.createDataFrame([(i % 7 or None, t) for i, t in enumerate(odd)], "id int, text string")
    for least in (0, 7):
        want = corpus.split_clauses(corpus.split_sentences(df, ["id"], "text"), ["id"], least).select("id", "sentence_no", "clause_no", T.words(F.col("clause")).alias("w"))
        got = corpus.clause_words(df, ["id"], "text", least)
        assert Counter((r.id, r.sentence_no, r.clause_no, " ".join(r.w)) for r in want.collect()) == Counter((r.id, r.sentence_no, r.clause_no, r._words.replace(corpus.MARK, " ")) for r in got.collect())
