"""Declared fields of saved pages."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, functions as F

# Where the stored pages keep each field (first group of the pattern).
PAGE_FIELDS = {"name": r"(?s)<title>(.*?)</title>", "heading": r"(?s)<h1>(.*?)</h1>", "language": r'<html lang="([^"]*)"'}
LINK = r'<a href="([^"]*)"'


def html_fields(pages: DataFrame, key: str, html: str, fields: Mapping[str, str] = PAGE_FIELDS) -> DataFrame:
    """One row per page; a field that is not there is null."""
    return pages.select(key, *[F.nullif(F.regexp_extract(html, pattern, 1), F.lit("")).alias(name)
                               for name, pattern in fields.items()])


def html_list(pages: DataFrame, key: str, html: str, pattern: str = LINK, name: str = "url") -> DataFrame:
    """One row per repeated element (links, listings)."""
    return pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(pattern), 1)).alias("position", name))
