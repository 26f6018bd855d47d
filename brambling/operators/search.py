"""Multi-criteria text search over clauses of listings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from brambling.functions import text as T
from brambling.operators.ordering import top_k, top_k_per_group


def query_tokens(query: str) -> list[str]:
    return sorted(set(re.sub(r"[^\w\s]", "", query.lower().strip()).split()))


def token_matches(text: Column, tokens: list[str]) -> Column:
    """How many of the tokens the text contains as substrings."""
    return sum((F.contains(text, F.lit(t)).cast("bigint") for t in tokens), F.lit(0).cast("bigint"))


def candidate_search(rows: DataFrame, query: str, text: str, key: list[str], cap: int | None = None) -> DataFrame:
    """Rows that contain any token, by tokens matched; ``cap`` keeps the best rows only."""
    hits = rows.withColumn("matched", token_matches(F.lower(text), query_tokens(query))).filter(F.col("matched") > 0)
    return hits if cap is None else top_k(hits, [F.desc("matched"), *key], cap)


def criteria_candidates(rows: DataFrame, queries: list[str], text: str) -> DataFrame:
    """All criteria in one pass over the rows: (row, criterion, wanted tokens)."""
    low = F.lower(text)
    hits = [F.when(token_matches(low, query_tokens(q)) > 0,
                   F.struct(F.lit(i).alias("criterion"), F.array(*map(F.lit, query_tokens(q))).alias("wanted")))
            for i, q in enumerate(queries)]
    return rows.select("*", F.explode(F.array_compact(F.array(*hits))).alias("_hit")).select(
        *rows.columns, F.col("_hit.criterion").alias("criterion"), F.col("_hit.wanted").alias("wanted"))


def hamming_score(candidates: DataFrame, text: str, max_terms: int | None = None) -> DataFrame:
    """Share of the criterion's vocabulary that is wanted and present in the row.

    The vocabulary of a criterion is the terms of its candidates, all of them unless ``max_terms`` asks
    for the most frequent only.  It is needed only as its size and as the wanted terms it holds: one row per
    criterion, so the rows themselves are never exploded twice or joined by term.
    """
    tokens = candidates.withColumn("_terms", T.terms(F.col(text)))
    counts = (tokens.select("criterion", F.explode("_terms").alias("term")).groupBy("criterion", "term")
              .agg(F.count(F.lit(1)).alias("n")))
    kept = counts if max_terms is None else top_k_per_group(counts, ["criterion"], [F.desc("n"), F.col("term")], max_terms, "_r")
    wanted = candidates.groupBy("criterion").agg(F.first("wanted").alias("_w"))
    size = (kept.join(F.broadcast(wanted), "criterion").groupBy("criterion")
            .agg(F.count(F.lit(1)).alias("_size"), F.collect_list(F.when(F.array_contains("_w", F.col("term")), F.col("term"))).alias("_in")))
    found = F.size(F.array_intersect("_terms", "_in"))
    return tokens.join(F.broadcast(size), "criterion").withColumn("score", found / F.col("_size")).drop("_terms", "_size", "_in", "wanted")


def multi_criteria_rank(rows: DataFrame, listing: str, scores: DataFrame, weights: list[float]) -> DataFrame:
    """Best score per listing and criterion, weighted, averaged over the criteria; listings without a hit get 0."""
    best = scores.groupBy(listing).agg(*[
        F.max(F.when(F.col("criterion") == i, F.col("score"))).alias(f"score{i + 1}") for i in range(len(weights))])
    every = rows.select(listing).distinct().join(best, listing, "left").fillna(0.0)
    total = sum((F.col(f"score{i + 1}") * float(w) for i, w in enumerate(weights)), F.lit(0.0)) / len(weights)
    return every.withColumn("total", total).orderBy(F.desc("total"), listing)


def best_evidence(scores: DataFrame, listing: str, key: str, text: str) -> DataFrame:
    """Top clause of every listing and criterion; the first in order of ``key`` (any sortable column) among equals."""
    return scores.groupBy(listing, "criterion").agg(
        F.min_by(text, F.struct(-F.col("score"), F.col(key))).alias("evidence"), F.max("score").alias("score"))


def cosine_search(rows: DataFrame, vector: str, wanted: list[float]) -> DataFrame:
    return rows.withColumn("similarity", T.cosine(F.col(vector), F.lit([float(x) for x in wanted])))
