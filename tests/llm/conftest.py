import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
ROOT = "/root/testdata/sf0.001"


def rows(df, *order):
    return [r.asDict(recursive=True) for r in df.orderBy(*(order or df.columns[:1])).collect()]


def clashing(df):
    """Extra columns whose names operators might use themselves."""
    return df.withColumns({c: F.lit(-5) for c in ("row", "size", "n", "cls", "gram", "upto", "tag", "kept", "w", "p", "t", "key", "host", "spans", "base", "length", "a.b")})


LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(30_000))
ODD = [  # nulls in any column, empty and blank texts, repeated rows and ids, one very long text
    (1, None, "en", "s1"), (2, "", None, None), (3, " \n\t ", "en", "s1"), (4, "one", "fr", "s2"), (4, "one", "fr", "s2"),
    (5, "one two three", None, "s1"), (None, "the cat sat on the mat with the hat", "en", None), (6, LONG, "en", "s2"), (7, LONG, "fr", "s1"),
    (8, "mail me at a.b@example.org or +33 1 23 45 67 89\nnow", "en", "s1"), (9, "mail me at a.b@example.org or +33 1 23 45 67 89\nnow", "en", "s2"),
    (10, "\U0001f600 été \x00 déjà vu 4111 1111 1111 1111", "fr", "s1"), (8, "another text under an id that is there", "en", "s1")]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    return clashing(spark.createDataFrame(ODD, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))).cache()


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{ROOT}/documents.parquet")
