import datetime as dt

from pyspark.sql import functions as F

from brambling.functions import columns as C, text as T


def one(spark, column, value, kind="double"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


def test_null_rules(spark):
    assert one(spark, lambda c: C.cap_max(c, 6.0), None) == 6.0
    assert one(spark, lambda c: C.cap_max(c, 6.0), 7.0) == 6.0
    assert one(spark, lambda c: C.binarize(c, 3.0), None) == 1
    assert one(spark, lambda c: C.binarize(c, 3.0), 3.0) == 0
    assert one(spark, lambda c: C.winsorize(c, 0.0, 5.0), None) is None
    assert one(spark, lambda c: C.winsorize(c, 0.0, 5.0), -1.0) == 0.0
    assert one(spark, lambda c: C.clamp_top(c, 5.0), None) is None
    assert one(spark, lambda c: C.ratio(c, F.lit(0.0)), 1.0) is None


def test_two_digit_years(spark):
    at = lambda v: one(spark, C.parse_mon_yy, v, "string")
    assert at("Jul-98") == dt.date(1998, 7, 1) and at("Jul-09") == dt.date(2009, 7, 1)
    assert at("Jan-69") == dt.date(1969, 1, 1) and at("Jan-68") == dt.date(2068, 1, 1)
    assert at("rubbish") is None


def test_business_day_and_season(spark):
    day = lambda v: one(spark, lambda c: C.business_day(c.cast("date")), v, "string")
    assert day("2024-01-06") == dt.date(2024, 1, 5) and day("2024-01-07") == dt.date(2024, 1, 8)
    assert day("2024-01-09") == dt.date(2024, 1, 9)
    label = lambda m: one(spark, C.season, m, "int")
    assert [label(m) for m in (12, 4, 7, 10, None)] == ["winter", "spring", "summer", "autum", "NA"]


def test_map_values_trims(spark):
    mapping = {"36 months": 36.0, "< 1 year": 0.5}
    get = lambda v: one(spark, lambda c: C.map_values(c, mapping), v, "string")
    assert get(" 36 months ") == 36.0 and get("< 1 year") == 0.5 and get("other") is None and get(None) is None


def test_words_treat_the_no_break_space_as_blank(spark):
    text = "  It's a TEST, of 2 cafés!\n"
    assert one(spark, T.words, text, "string") == ["its", "a", "test", "of", "cafs"]
    assert one(spark, T.normalize, text, "string") == "test cafs"


def test_sentences_and_clauses(spark):
    assert one(spark, T.sentences, "One two. Three!  Four? five\nsix", "string") == ["One two", "Three", "Four", "five", "six"]
    assert one(spark, T.clauses, "The room was big, clean and the bed; fine", "string") == ["the room was big", "clean", "the bed", "fine"]
