"""The review study end to end: corpus, search, ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brambling.functions import text as T
from brambling.operators import corpus, search
from brambling.session import settle


def build_corpus(reviews: DataFrame, key: str, listing: str, text: str, model: DataFrame, languages: list[str],
                 keep: str = "en", min_words: int = 7) -> tuple[DataFrame, DataFrame]:
    """Sentences and cleaned clauses of the reviews in one language."""
    kept = corpus.detect_language(reviews, key, text, model, languages).filter(F.col("detected") == keep)
    sentences = corpus.split_sentences(kept, [listing, key], text)
    clauses = corpus.split_clauses(sentences, [listing, key], min_words)
    return sentences, clauses.withColumn("text_clean", T.normalize(F.col("clause")))


def rank_listings(clauses: DataFrame, listing: str, key: str, text: str, queries: list[str], weights: list[float]) -> tuple[DataFrame, DataFrame]:
    """Ranked listings and, per listing and criterion, the clause that speaks for it."""
    hits = settle(search.criteria_candidates(clauses.select(listing, key, text), queries, F.col(text)))
    scores = settle(search.hamming_score(hits, text))
    return (search.multi_criteria_rank(clauses, listing, scores, weights),
            search.best_evidence(scores, listing, key, text))
