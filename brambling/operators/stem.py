"""Porter's published suffix rules, applied once per distinct word as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A word is [C](VC)^m[V]; the patterns test m and the vowel conditions of the published rules.
_C, _V = "(?:[^aeiou][^aeiouy]*)", "(?:[aeiouy][aeiou]*)"
M_ABOVE_0 = f"^{_C}?{_V}{_C}"
M_IS_1 = f"^{_C}?{_V}{_C}{_V}?$"
M_ABOVE_1 = f"^{_C}?{_V}{_C}{_V}{_C}"
HAS_VOWEL = f"^{_C}?[aeiouy]"
SHORT_END = f"^{_C}[aeiouy][^aeiouwxy]$"

# The published suffix tables (suffix, replacement).
STEP_2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
          ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
          ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
          ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"))
STEP_3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti",
          "ous", "ive", "ize")


def _swap(w: Column, table, condition: str) -> Column:
    """Replace the longest suffix of the table that fits, if the rest of the word meets the condition."""
    rule = None
    for suffix, new in sorted(table, key=lambda r: -len(r[0])):
        rest = F.left(w, F.length(w) - len(suffix))
        done = F.when(rest.rlike(condition), F.concat(rest, F.lit(new))).otherwise(w)
        rule = F.when(w.endswith(suffix), done) if rule is None else rule.when(w.endswith(suffix), done)
    return rule.otherwise(w)


def _plural(w: Column) -> Column:
    return (F.when(w.endswith("sses") | w.endswith("ies"), F.left(w, F.length(w) - 2))
            .when(w.endswith("ss"), w).when(w.endswith("s"), F.left(w, F.length(w) - 1)).otherwise(w))


def _cut_participle(w: Column) -> Column:
    """The word without -ed or -ing where a vowel is left, else null."""
    ed, ing = F.left(w, F.length(w) - 2), F.left(w, F.length(w) - 3)
    return F.when(w.endswith("eed"), None).when(w.endswith("ed") & ed.rlike(HAS_VOWEL), ed).when(w.endswith("ing") & ing.rlike(HAS_VOWEL), ing)


def _mend(cut: Column) -> Column:
    double = cut.rlike(r"([^aeiouylsz])\1$")
    return (F.when(cut.rlike("(at|bl|iz)$"), F.concat(cut, F.lit("e"))).when(double, F.left(cut, F.length(cut) - 1))
            .when(cut.rlike(SHORT_END), F.concat(cut, F.lit("e"))).otherwise(cut))


def _step_4(w: Column) -> Column:
    rule = None
    for suffix in sorted((*STEP_4, "ion"), key=lambda s: -len(s)):
        rest = F.left(w, F.length(w) - len(suffix))
        fits = rest.rlike(M_ABOVE_1) & rest.rlike("[st]$") if suffix == "ion" else rest.rlike(M_ABOVE_1)
        done = F.when(fits, rest).otherwise(w)
        rule = F.when(w.endswith(suffix), done) if rule is None else rule.when(w.endswith(suffix), done)
    return rule.otherwise(w)


def _last_e(w: Column) -> Column:
    rest = F.left(w, F.length(w) - 1)
    return F.when(w.endswith("e") & (rest.rlike(M_ABOVE_1) | (rest.rlike(M_IS_1) & ~rest.rlike(SHORT_END))), rest).otherwise(w)


def stem_words(vocabulary: DataFrame, word: str = "word", name: str = "stem") -> DataFrame:
    """Add the stem of each word; words of one or two letters stay."""
    w = F.col("_w")
    df = vocabulary.withColumn("_w", _plural(F.col(word)))
    df = df.withColumn("_cut", _cut_participle(w))
    eed = F.left(w, F.length(w) - 3)
    df = df.withColumn("_w", F.when(w.endswith("eed"), F.when(eed.rlike(M_ABOVE_0), F.left(w, F.length(w) - 1)).otherwise(w))
                       .when(F.col("_cut").isNotNull(), _mend(F.col("_cut"))).otherwise(w))
    rest = F.left(w, F.length(w) - 1)
    df = df.withColumn("_w", F.when(w.endswith("y") & rest.rlike(HAS_VOWEL), F.concat(rest, F.lit("i"))).otherwise(w))
    for step in (lambda c: _swap(c, STEP_2, M_ABOVE_0), lambda c: _swap(c, STEP_3, M_ABOVE_0), _step_4, _last_e):
        df = df.withColumn("_w", step(w))
    df = df.withColumn("_w", F.when(w.rlike(M_ABOVE_1) & w.endswith("ll"), F.left(w, F.length(w) - 1)).otherwise(w))
    return df.withColumn(name, F.when(F.length(word) > 2, w).otherwise(F.col(word))).drop("_w", "_cut")
