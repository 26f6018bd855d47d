"""One pass over the rows that serves many models: every task adds up numbers for each, the sums meet by model."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 2_048               # rows worked on at a time
PASS_BYTES = 32_000_000     # sums that one pass brings to the driver


def sums_by_model(rows: DataFrame, models: dict[int, Any], work: Callable[[np.ndarray, Any], np.ndarray], chunk: int = CHUNK) -> dict[int, np.ndarray]:
    """``work(matrix, model)`` added up over all rows for every model; ``rows`` hold one array column of equal lengths.

    The sums of the tasks are added by model in a second stage, so one row of numbers per model reaches the driver.
    """
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def gather(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1)
            for at in range(0, len(x), chunk):
                for i, model in shared.value.items():
                    new = work(x[at:at + chunk], model)
                    sums[i] = sums[i] + new if i in sums else new
        yield _packed(sums)

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1)):
                new = np.frombuffer(raw.as_buffer(), np.float64)
                sums[i] = sums[i] + new if i in sums else new
        yield _packed(sums)

    schema = "model int, sums binary"
    met = rows.mapInArrow(gather, schema).repartition("model").mapInArrow(add, schema).collect()
    shared.unpersist()
    return {row["model"]: np.frombuffer(row["sums"], np.float64) for row in met}


def _packed(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["model", "sums"])


def dealt(models: dict[int, Any], size: Callable[[Any], int], limit: int = PASS_BYTES) -> list[dict[int, Any]]:
    """Models dealt to passes whose sums (``size`` numbers each) stay below ``limit`` bytes, or to one of their own."""
    out: list[dict[int, Any]] = []
    room = 0
    for i, m in models.items():
        need = 8 * size(m)
        if not out or need > room:
            out.append({})
            room = limit
        out[-1][i] = m
        room -= need
    return out
