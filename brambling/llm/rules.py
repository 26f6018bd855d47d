"""Quality rules: text statistics and learned decision lists, as Spark column expressions.

Statistics are computed inside the row from its words, without exploding them.  Three-word windows are
sorted by a 64-bit hash, then by their words, then by position, so equal windows are neighbours in texts of
every length; the words decide whether two neighbours are equal.

A decision list is learned by sequential covering on a bounded sample of labelled documents: a conjunction
of thresholds is grown by information gain on two thirds of the sample, pruned on the rest, kept if it is
precise there, and what it covers is set aside before the next.  The list becomes one conditional
expression; documents that no rule rejects are kept.

Defined cases: a null text has no words and every statistic 0; labels that contradict each other count as
bad quality; ids without a label or labels without a document teach nothing; with no labels nothing beyond
the base rule is rejected; ties between literals go to the first statistic and the lowest threshold; an
empty table gives no rows; extra columns stay in ``row``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from brambling.llm.common import SPACE, WORD, col, row_tag, settle

MAX_LABELLED = 20_000   # labelled documents the rules are learned from
MAX_RULES, MAX_LITERALS, MIN_COVER, MIN_PRECISION = 12, 3, 5, 0.95
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words(text: Column) -> Column:
    """The words of a text as an array; null gives an empty one."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def window_hash(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + k) for k in range(3)])


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the input row as a struct), the statistics of its text, all long, and ``tag``, a number of its own."""
    given = docs.select(F.struct("*").alias("row"), F.coalesce(col(text), F.lit("")).alias("t"))
    w, n, p = F.col("w"), F.col("n_words"), F.col("p")
    cut = given.select("row", "t", words(F.col("t")).alias("w"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    counted = cut.select(
        "row", "w", F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.octet_length("t") - F.octet_length(F.regexp_replace("t", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"), lines.alias("lines"))
    counted = counted.select("row", "w", "n_words", "word_chars", "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    window = lambda i: F.struct(window_hash(w, i).alias("h"), *[F.get(w, i + k).alias(f"w{k}") for k in range(3)], i.alias("at"))
    none = F.array().cast("array<struct<h:bigint,w0:string,w1:string,w2:string,at:int>>")
    sorted_windows = counted.withColumn("p", F.when(n >= 4, F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), window))).otherwise(none))
    same = lambda i: reduce(lambda a, b: a & b, [F.get(p, i)[c] == F.get(p, i + 1)[c] for c in ("h", "w0", "w1", "w2")])
    hits = F.filter(F.sequence(F.lit(0), F.size(p) - 2), same)
    starts = F.when(F.size(p) < 2, F.array().cast("array<int>")).otherwise(F.flatten(F.transform(hits, lambda i: F.array(F.get(p, i)["at"], F.get(p, i + 1)["at"]))))
    found = sorted_windows.select("row", *STATISTICS[:4], starts.alias("s"))
    covered = F.array_distinct(F.flatten(F.transform("s", lambda i: F.array(i, i + 1, i + 2))))
    # the tag is not deterministic, so a filter on the statistics that uses it stays above them; pushed below, it would
    # compute the arrays again for every element
    return found.select("row", *STATISTICS[:4], F.size(covered).cast("long").alias("n_repeat_words"), row_tag().alias("tag"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """What rules may ask: shares per word, which mean the same in short and long texts."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {"symbols_per_word": F.col("n_symbols") / n, "repeat_share": F.col("n_repeat_words") / n, "mean_word": F.col("word_chars") / n,
            "dup_lines_per_word": F.col("n_dup_lines") / n, "n_words": F.col("n_words").cast("double")}


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


Rule = tuple[Literal, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    return reduce(lambda a, l: a & l.holds(x), rule, np.ones(n, bool))


def _best_literal(x: dict[str, np.ndarray], bad: np.ndarray) -> Literal | None:
    """The threshold with the greatest gain over the rows left."""
    p0, n0 = bad.sum(), len(bad) - bad.sum()
    best, found = 1e-9, None
    for name in x:
        order = np.argsort(x[name], kind="stable")
        value, hit = x[name][order], np.cumsum(bad[order])
        ends = np.flatnonzero(value[1:] > value[:-1])
        for above in (False, True):
            p = (p0 - hit[ends]) if above else hit[ends]
            total = (len(bad) - ends - 1) if above else ends + 1
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / total) - np.log2(p0 / (p0 + n0))), 0)
            if len(gain) and gain.max() > best:
                k = int(gain.argmax())
                best, found = gain[k], Literal(name, above, float((value[ends[k]] + value[ends[k] + 1]) / 2))
    return found


def learn(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Rules that reject, in order; row i is held back for pruning when i is divisible by 3."""
    rows = np.arange(len(bad))
    left, rules = np.ones(len(bad), bool), []
    pick = lambda keep: {k: v[keep] for k, v in x.items()}
    while len(rules) < MAX_RULES:
        grow, prune = left & (rows % 3 != 0), left & (rows % 3 == 0)
        rule: Rule = ()
        inside = grow
        while len(rule) < MAX_LITERALS and bad[inside].any() and not bad[inside].all():
            literal = _best_literal(pick(inside), bad[inside])
            if literal is None:
                break
            rule += (literal,)
            inside = inside & literal.holds(x)
        if not rule or inside.sum() < MIN_COVER:
            break

        def worth(r: Rule) -> tuple[float, int]:
            hit = _covers(r, x, len(bad)) & prune
            p, n = bad[hit].sum(), hit.sum() - bad[hit].sum()
            return ((p - n) / (p + n) if hit.any() else -1.0, -len(r))

        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=worth)
        hit = _covers(rule, x, len(bad)) & left
        held = hit & prune
        if hit.sum() < MIN_COVER or bad[hit].mean() < MIN_PRECISION or (held.any() and bad[held].mean() < MIN_PRECISION):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, id: str = "doc_id", text: str = "text",
        label: str = "quality") -> list[Rule]:
    """Learn from at most ``limit`` labelled documents, the first in a seeded order of their ids."""
    known = (labels.filter(col(label).isNotNull() & col(id).isNotNull()).groupBy(col(id).alias("l_id")).agg(F.min(col(label)).alias("l_quality"))
             .orderBy(F.xxhash64("l_id"), "l_id").limit(limit))
    named = docs.select(col(id).alias("l_id"), col(text).alias("text"))
    met = with_statistics(named.join(F.broadcast(known), "l_id"))
    seen = settle(met.select("row.l_id", F.col("row.l_quality").alias("q"), *STATISTICS))
    shown = seen.filter(~base_failed()).select("l_id", "q", *[c.alias(n) for n, c in features().items()])
    one = shown.groupBy("l_id").agg(F.min(F.struct("q", *features())).alias("f"))     # a repeated id teaches once
    got = one.orderBy(F.xxhash64("l_id"), "l_id").select("f.*").collect()              # at most ``limit`` rows
    x = {name: np.array([r[name] for r in got], float) for name in features()}
    return learn(x, np.array([r.q == 0 for r in got], bool))


def fired(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects, from 1; 0 if none does."""
    out = F.when(F.lit(False), F.lit(0))
    for k, rule in enumerate(rules, 1):
        out = out.when(reduce(lambda a, b: a & b, [l.column() for l in rule]), F.lit(k))
    return out.otherwise(F.lit(0))


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``row``, the statistics, base_failed, rule (of a rejection) and kept for every row."""
    seen = with_statistics(docs, text).drop("tag").withColumns({"base_failed": base_failed(), "rule": fired(rules)})
    return seen.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def keep(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The rows that neither the base rule nor a learned rule rejects, unchanged."""
    seen = with_statistics(docs, text)
    return seen.filter(~base_failed() & (fired(rules) == 0) & (F.col("tag") >= 0)).select("row.*")
