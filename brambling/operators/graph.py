"""Weighted term graphs from tagged tokens, as edge tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from brambling.operators.aggregate import group_count
from brambling.operators.corpus import grouped_words, looked_up, runs
from brambling.operators.lookup import sized

NOUNS = ("noun", "connector")


TAGS = pa.array(["noun", "connector", "compound", "adjective"])
NOUN, CONNECTOR, COMPOUND, ADJECTIVE = range(4)


def _fields(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def tag_tokens(clauses: DataFrame, keys: list[str], tokens: str | None, lexicon: DataFrame) -> DataFrame:
    """(keys, tokens, tags): each clause with the tags of its tokens from a (word, tag) table; unknown words get none.

    ``tokens`` names an array; None for clauses that are rows of ``marked_words``."""
    grouped, needed = grouped_words(clauses, keys, F.col(tokens) if tokens else None, together=True)

    def tagged(rows, cut, found, codes):
        words, row, place = cut
        run = runs(rows, keys)
        if run[-1] + 1 < len(run):          # rows with equal keys are one clause, token by token
            nth = np.arange(len(row)) - np.searchsorted(row, row)
            by = np.lexsort((nth, run[row]))
            row, words, place = row[by], words.take(pa.array(by)), place[by]
            row = run[row]
        first = np.flatnonzero(np.diff(run, prepend=-1))
        ends = pa.array(np.searchsorted(row, np.arange(len(first) + 1)).astype(np.int32))
        at = np.unique(codes, return_index=True)[1]
        tags = found.column("tag").combine_chunks().take(pa.array(at[np.maximum(place, 0)], mask=place < 0)) if found.num_rows else pa.nulls(len(words), pa.string())
        return pa.table({**{k: rows.column(k).take(pa.array(first)) for k in keys}, "tokens": pa.ListArray.from_arrays(ends, words.dictionary_decode()), "tags": pa.ListArray.from_arrays(ends, tags)})

    return looked_up(grouped, needed, lexicon.select("word", "tag"), tagged, f"{_fields(clauses, keys)}, tokens array<string>, tags array<string>", keys)


def _pairs(tagged: DataFrame, keys: list[str], names: tuple[str, str], choose) -> DataFrame:
    """Pairs of tokens of one clause; ``choose(code, start, words)`` gives their places."""
    def paired(batches):
        for b in batches:
            lists = b.column(len(keys))
            words = lists.flatten()
            code = pc.fill_null(pc.index_in(b.column(len(keys) + 1).flatten(), value_set=TAGS), -1).to_numpy()
            size = pc.list_value_length(lists).to_numpy()
            row, start = np.repeat(np.arange(b.num_rows), size), np.repeat(np.cumsum(size) - size, size)
            one, two = choose(code, start, words.dictionary_encode().indices.to_numpy())
            at = pa.array(row[one])
            yield pa.RecordBatch.from_arrays([*[b.column(i).take(at) for i in range(len(keys))], words.take(pa.array(one)), words.take(pa.array(two))], names=[*keys, *names])

    return tagged.select(*keys, "tokens", "tags").mapInArrow(paired, f"{_fields(tagged, keys)}, {names[0]} string, {names[1]} string")


def _last_connector(code: np.ndarray) -> np.ndarray:
    """The place of the last connector up to each token, -1 if there is none."""
    return np.maximum.accumulate(np.where(code == CONNECTOR, np.arange(len(code)), -1)) if len(code) else np.empty(0, np.int64)


def adjacent_pairs(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """For each noun: the last connector noun, the compound word before it, adjectives within two tokens."""
    def choose(code, start, word):
        noun = np.flatnonzero((code == NOUN) | (code == CONNECTOR))
        link = _last_connector(code)[noun]
        linked = (link >= start[noun]) & (word[link] != word[noun])
        found = [(noun[linked], link[linked])]
        for step, kind in ((-1, COMPOUND), (-2, ADJECTIVE), (-1, ADJECTIVE), (1, ADJECTIVE), (2, ADJECTIVE)):
            at = np.clip(noun + step, 0, max(len(code) - 1, 0))
            near = (at == noun + step) & (start[at] == start[noun]) & (code[at] == kind)
            found.append((noun[near], at[near]))
        return tuple(np.concatenate(side) for side in zip(*found))

    return _pairs(tagged, keys, ("obj1", "obj2"), choose)


def nearest_subject(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """Each object noun or adjective with the nearest subject before it in the clause (one pair per token)."""
    def choose(code, start, word):
        before = np.concatenate([[-1], _last_connector(code)[:-1]]).astype(np.int64)[:len(code)]
        object_ = np.flatnonzero(((code == NOUN) | (code == ADJECTIVE)) & (before >= start))
        return before[object_], object_

    return _pairs(tagged, keys, ("subject", "object"), choose)


def edge_table(pairs: DataFrame, lemmas: DataFrame, missing: str = "na") -> DataFrame:
    """Lower-case, lemma, and no edge to the marker for a missing word."""
    out = pairs.withColumns({c: F.lower(c) for c in ("obj1", "obj2")})
    known = sized(lemmas)
    for c in ("obj1", "obj2"):
        named = known.select(F.col("word").alias(c), F.col("lemma").alias(f"_{c}"))
        out = out.join(named, c, "left").withColumn(c, F.coalesce(F.col(f"_{c}"), F.col(c))).drop(f"_{c}")
    return out.filter((F.col("obj1") != missing) & (F.col("obj2") != missing))


def edge_weight(edges: DataFrame) -> DataFrame:
    return group_count(edges, ["obj1", "obj2"], "weight")


def weighted_edges(pairs: DataFrame, lemmas: DataFrame, missing: str = "na") -> DataFrame:
    """Edges with their weight straight from word pairs: pairs are counted before they are named, so the lookups see
    each distinct pair once and no frequent word's rows meet in one task."""
    counted = group_count(pairs.select(F.lower("obj1").alias("obj1"), F.lower("obj2").alias("obj2")), ["obj1", "obj2"], "weight")
    return edge_table(counted, lemmas, missing).groupBy("obj1", "obj2").agg(F.sum("weight").alias("weight"))


def degree_filter(edges: DataFrame, degree: int) -> DataFrame:
    """Edges with either end of more than ``degree`` distinct neighbours (undirected; a self loop counts twice)."""
    pair = edges.select("obj1", "obj2").distinct()
    ends = pair.union(pair.select("obj2", "obj1")).toDF("node", "other").distinct()
    degrees = ends.groupBy("node").agg((F.count(F.lit(1)) + F.count_if(F.col("node") == F.col("other"))).alias("d"))
    big = degrees.filter(F.col("d") > degree).select("node")
    marked = (edges.join(big.withColumnRenamed("node", "obj1").withColumn("_m1", F.lit(True)), "obj1", "left")
              .join(big.withColumnRenamed("node", "obj2").withColumn("_m2", F.lit(True)), "obj2", "left"))
    return marked.filter(F.col("_m1").isNotNull() | F.col("_m2").isNotNull()).select(*edges.columns)


def entity_counts(edges: DataFrame, nouns: DataFrame) -> DataFrame:
    """Nouns among both ends of weighted edges by frequency."""
    ends = edges.select(F.col("obj1").alias("word"), "weight").union(edges.select("obj2", "weight"))
    counts = ends.groupBy("word").agg(F.sum("weight").alias("n"))
    return counts.join(nouns, "word", "left_semi").orderBy(F.desc("n"), "word")


def entity_filter(edges: DataFrame, entities: list[str]) -> DataFrame:
    return edges.filter(F.col("obj1").isin(*entities) | F.col("obj2").isin(*entities))
