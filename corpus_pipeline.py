"""Documents to training sequences: quality rules, near duplicates, personal data, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brambling.llm import jaccard, mix, pack, pii, rules
from brambling.llm.common import settle, table
from brambling.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the base rule or a rule learned from the labels rejects."""
    return rules.keep(docs, rules.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts."""
    return pii.redacted(docs, pii.fit(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources come to their weights."""
    return mix.mixed_rows(docs, F.array("source"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of binary lengths, each a sequence with its ids."""
    return pack.pack(pack.decompose(docs, vocabulary()))


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates), ("PII", personal_data),
          ("mixing sources to target weights", mixing), ("packing", packing)]

#: Learned rules, a trained network, min-cost flow and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every result is written as Parquet and read again by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs)
    return docs
