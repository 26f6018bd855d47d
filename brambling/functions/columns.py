"""Column rules for cleansing and feature building."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, functions as F

# Month numbers of each season and the labels results must carry.
SEASON_MONTHS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8), "autum": (9, 10, 11)}
SEASON_UNKNOWN = "NA"


def null_token(col: Column, token: str = "?") -> Column:
    return F.nullif(col, F.lit(token))


def map_values(col: Column, mapping: Mapping) -> Column:
    """Dictionary lookup after trimming both ends; an unmapped value becomes null."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.trim(col))


def cap_max(col: Column, limit: float) -> Column:
    """Values at or above the limit become the limit, and so does null."""
    return F.when(col < limit, col).otherwise(F.lit(limit))


def clamp_top(col: Column, limit: float) -> Column:
    """Upper clamp that keeps null."""
    return F.when(col > limit, F.lit(limit)).otherwise(col)


def binarize(col: Column, limit: float) -> Column:
    """0 up to the limit, else 1; null counts as above."""
    return F.when(col <= limit, F.lit(0)).otherwise(F.lit(1))


def winsorize(col: Column, low: float, high: float) -> Column:
    return F.when(col <= low, F.lit(low)).when(col >= high, F.lit(high)).otherwise(col)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def log_target(col: Column) -> Column:
    return F.ln(col)


def season(month: Column, months: Mapping[str, tuple] = SEASON_MONTHS, unknown: str = SEASON_UNKNOWN) -> Column:
    rule = None
    for label, numbers in months.items():
        hit = month.isin(*numbers)
        rule = F.when(hit, label) if rule is None else rule.when(hit, label)
    return rule.otherwise(unknown)


def parse_mon_yy(col: Column) -> Column:
    """``Jul-09`` to a date; years 69 to 99 belong to the last century."""
    year = F.try_to_number(F.substring(col, -2, 2), F.lit("99")).cast("int")
    text = F.concat(F.substring(col, 1, 4), F.when(year >= 69, "19").otherwise("20"), F.substring(col, -2, 2))
    return F.try_to_timestamp(text, F.lit("MMM-yyyy")).cast("date")


def years_between(later: Column, earlier: Column) -> Column:
    return F.year(later) - F.year(earlier)


def business_day(day: Column) -> Column:
    """Saturday moves to Friday, Sunday to Monday."""
    weekday = F.weekday(day)
    return F.when(weekday == 5, F.date_sub(day, 1)).when(weekday == 6, F.date_add(day, 1)).otherwise(day)


def threshold_predict(prob: Column, threshold: float) -> Column:
    return F.when(prob > threshold, F.lit(1)).otherwise(F.lit(0))


def rescale(vector: Column, constant: float) -> Column:
    return F.transform(vector, lambda x: x.cast("double") / F.lit(float(constant)))


def hash_bucket(*parts: Column, seed: int = 42, buckets: int = 100) -> Column:
    """Stable bucket number from the first 32 bits of an md5 over the parts and the seed."""
    return F.pmod(hash_number(*parts, seed=seed), F.lit(buckets)).cast("bigint")


def hash_number(*parts: Column, seed: int = 42) -> Column:
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
