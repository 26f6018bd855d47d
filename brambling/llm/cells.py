"""Comparing the members of buckets in cells of bounded size.

A bucket has members that stand on its left side (``home``) and all of them on its right; every left one is to be
compared with every right one.  A bucket above the bound is cut into blocks of both sides, and each pair of blocks
is a cell of its own, so a crowded bucket spreads over tasks.  Pairs are formed inside a cell only, never as rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def parts(count: str, cell: int) -> Column:
    """Blocks of at most ``cell`` members."""
    return F.ceil(F.col(count) / cell).cast("long")


def deal(keyed: DataFrame, heavy: DataFrame | None) -> DataFrame:
    """Adds the cell (lp, rp) and whether the row stands on its left and right side; heavy buckets' rows are dealt to several."""
    if heavy is None:
        return keyed.withColumns({"lp": F.lit(0), "rp": F.lit(0), "left": F.col("home"), "right": F.lit(True)})
    met = keyed.join(heavy, ["dim", "tab", "code"], "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("nl", "nr")})
    lp, rp = F.pmod(F.xxhash64("cls"), F.col("nl")).cast("int"), F.pmod(F.xxhash64("cls", F.lit(1)), F.col("nr")).cast("int")
    span = lambda n: F.sequence(F.lit(0), n.cast("int") - 1)
    cell = lambda a, b, left, right: F.struct(a.alias("lp"), b.alias("rp"), left.alias("left"), right.alias("right"))
    no, yes = F.lit(False), F.lit(True)
    lefts = F.when(F.col("home"), F.transform(span(F.col("nr")), lambda k: cell(lp, k, yes, no))).otherwise(F.array().cast("array<struct<lp:int,rp:int,left:boolean,right:boolean>>"))
    rights = F.transform(span(F.col("nl")), lambda k: cell(k, rp, no, yes))
    whole = F.array(cell(F.lit(0), F.lit(0), F.col("home"), yes))
    dealt = F.when((F.col("nl") == 1) & (F.col("nr") == 1), whole).otherwise(F.concat(lefts, rights))
    return met.withColumn("_cell", F.explode(dealt)).select(*keyed.columns, "_cell.*")


def whole_runs(batches, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches that end where a run of equal keys ends; a run is bounded by the size of a cell."""
    kept: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        if kept:
            b = pa.Table.from_batches([*kept, b]).combine_chunks().to_batches()[0]
        change = np.zeros(b.num_rows - 1, bool)
        for k in keys:
            v = b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            change |= v[1:] != v[:-1]
        ends = np.flatnonzero(change)
        cut = int(ends[-1]) + 1 if len(ends) else 0
        if cut:
            yield b.slice(0, cut)
        kept = [b.slice(cut)]
    if kept:
        yield kept[0]


def pairs_of(start: np.ndarray, left: np.ndarray, right: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of all (left, right) in every group, at most about ``most`` pairs at a time."""
    group = np.cumsum(start) - 1
    r_at = np.flatnonzero(right)
    r_count = np.bincount(group[r_at], minlength=group[-1] + 1)
    r_first = np.concatenate([[0], np.cumsum(r_count)[:-1]])
    l_at = np.flatnonzero(left)
    load = np.cumsum(r_count[group[l_at]])
    lo = 0
    while lo < len(l_at):
        hi = max(int(np.searchsorted(load, (load[lo - 1] if lo else 0) + most, "right")), lo + 1)
        part = l_at[lo:hi]
        k = r_count[group[part]]
        inside = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        yield np.repeat(part, k), r_at[np.repeat(r_first[group[part]], k) + inside]
        lo = hi
