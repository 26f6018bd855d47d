"""Stored review and search answers: nested JSON to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

REVIEW_DOCUMENT = T.StructType([T.StructField("accommodation_id", T.StringType()), T.StructField("reviews", T.StringType())])
REVIEWS = T.StructType([T.StructField("result", T.ArrayType(T.StructType([
    T.StructField("pros", T.StringType()), T.StructField("cons", T.StringType())])))])

# The fields of a search result and the columns they become.
ENTITY_FIELDS = {"hotel_id": "hotel_id", "hotel_name": "hotel_name", "review_nr": "review_nr", "zip": "zipcode",
                 "url": "url", "max_photo_url": "max_photo_url"}


def read_json_dir(spark: SparkSession, path: str, schema: T.StructType = REVIEW_DOCUMENT) -> DataFrame:
    """All documents below a folder, with an explicit schema."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def explode_reviews(documents: DataFrame) -> DataFrame:
    """One row per review; the inner payload is a JSON text of its own.  Missing halves count as empty."""
    inner = documents.select("accommodation_id", F.explode(F.from_json("reviews", REVIEWS)["result"]).alias("r"))
    pros, cons = F.coalesce("r.pros", F.lit("")), F.coalesce("r.cons", F.lit(""))
    return inner.select("accommodation_id", F.col("r.pros").alias("pros"), F.col("r.cons").alias("cons"),
                        F.concat(pros, F.lit(". "), cons).alias("review"))


def rejected(documents: DataFrame) -> DataFrame:
    """Documents whose payload does not parse, counted instead of lost in silence."""
    bad = F.from_json("reviews", REVIEWS)["result"].isNull()
    return documents.agg(F.count(F.lit(1)).alias("documents"), F.count_if(bad).alias("rejected"))


def entity_summary(answers: DataFrame, result: str = "result") -> DataFrame:
    """Six fields of every entity in the nested search results."""
    return answers.select(F.explode(result).alias("r")).select(*[F.col(f"r.{a}").alias(b) for a, b in ENTITY_FIELDS.items()])
