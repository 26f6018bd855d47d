import os

import duckdb
import pytest

import __spark_entry__ as entry
from brambling.sources import reviews, tables

ROOT = "/root/testdata/sf0.001"
SAMPLE = ["pf10_cap_max", "j1_left_merge", "ag7_distinct_counts", "so9_stratified_split", "st6_iqr_bounds", "ev5_roc_auc",
          "wn10_position_cutloss", "fe8_prepare_credit", "tx5_keep_language", "tx13_multi_criteria_rank", "rc3_recommend", "gr4_degree_filter", "ss3_one_per_bar"]


def test_statements_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 180


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="needs the shared test tables")
def test_flagship_query_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["symbol", "open_time", "position", "strategy", "creturns", "strategy_creturns"] and df.count() > 0


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="needs the shared test tables")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_gives_the_rows_of_its_statement(spark, name):
    con = duckdb.connect()
    for f in os.listdir(ROOT):
        con.execute(f"create view {f.split('.')[0]} as select * from '{ROOT}/{f}'")
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = sorted(map(repr, (tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall())))
    df = entry.queries()[name](spark, ROOT)
    got = sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))
    assert sorted(df.columns) == sorted(names) and got == want


def test_broken_review_documents_are_counted(spark):
    rows = [("h1", '{"result": [{"pros": "good", "cons": null}, {"pros": "big", "cons": "loud"}]}'), ("h2", "{broken"), ("h3", '{"result": []}')]
    docs = spark.createDataFrame(rows, reviews.REVIEW_DOCUMENT)
    assert sorted(r.review for r in reviews.explode_reviews(docs).collect()) == ["big. loud", "good. "]
    counted = reviews.rejected(docs).first()
    assert (counted.documents, counted.rejected) == (3, 1)


def test_csv_keeps_types_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", None), (2, 'q"q', 2.5)], "i bigint, s string, d double")
    tables.write_csv(df, str(tmp_path / "x"))
    back = tables.read_csv(spark, str(tmp_path / "x"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


FULL_SIZE = {"ml6_forest_regressor": ("forest_regressor", 1), "ml7_gbt_regressor": ("gbt_regressor", 1), "ml9_forest_classifier": ("forest_classifier", 1),
             "ml10_gbt_classifier": ("gbt_classifier", 1), "ml11_boosted_classifier": ("gbt_classifier", 1), "ml17_gaussian_mixtures": ("gaussian_mixtures", 2),
             "fe12_forward_select": ("forward_select", 3), "fe13_backward_eliminate": ("backward_eliminate", 3)}


class Called(Exception):
    pass


@pytest.mark.parametrize("name", [*FULL_SIZE, "ml21_lag_forecast", "tx7_train_word_vectors"])
def test_model_queries_run_at_full_size(spark, monkeypatch, name):
    """No size, level or number of rounds is passed, so that the functions' defaults hold."""
    from brambling.operators import corpus, models
    from brambling.plans import forecast
    special = {"ml21_lag_forecast": (forecast, "lag_forecast", 2), "tx7_train_word_vectors": (corpus, "train_word_vectors", 2)}
    module, function, given = special.get(name) or (models, *FULL_SIZE[name])

    def seen(*a, **k):
        raise Called(a, k)
    monkeypatch.setattr(module, function, seen)
    with pytest.raises(Called) as called:
        entry.queries()[name](spark, ROOT)
    a, k = called.value.args
    assert len(a) == given and not {"trees", "rounds", "features", "level", "starts", "lags", "size", "window", "epochs"} & set(k)
    assert name != "ml17_gaussian_mixtures" or a[1] == list(range(1, 20))
