"""One-pass sums of numpy vectors over a DataFrame.

Iterative fits need, per pass, a few sums whose size depends on the model and not on the
rows.  Each task adds up its batches in numpy and emits one small set of partial sums; Spark
combines them by (slot, position) and only the totals reach the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskframe.operators.placement import Kept

SCHEMA = "slot int, pos int, value double"
Kernel = Callable[[pa.RecordBatch], dict[int, np.ndarray]]


def matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An ``array<double>`` column as an (n, p) matrix over the Arrow buffer."""
    column = batch.column(batch.schema.get_field_index(name))
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def vector(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


DIRECT_TASKS = 64  # partial sums of up to this many tasks are added on the driver


def summed(rows: Kept, kernel: Kernel) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Total of ``kernel`` over all batches as ``{slot: (positions, values)}``.

    Partial sums of many tasks are combined by a shuffle; those of a few tasks (each within
    the caller's budget) go straight to the driver, which saves a stage per pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for slot, values in kernel(batch).items():
                if slot in acc:
                    acc[slot] += values
                else:
                    acc[slot] = np.array(values, dtype=float)
        for slot, values in acc.items():
            pos = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(pos), slot, dtype=np.int32)),
                    pa.array(pos.astype(np.int32)),
                    pa.array(values[pos]),
                ],
                names=["slot", "pos", "value"],
            )

    parts = rows.df.mapInArrow(run, SCHEMA)
    if rows.tasks > DIRECT_TASKS:
        parts = parts.groupBy("slot", "pos").agg(F.sum("value").alias("value"))
    table = parts.toArrow()
    slot, pos, value = (table.column(c).to_numpy() for c in ("slot", "pos", "value"))
    out = {}
    for s in np.unique(slot):
        mine = slot == s
        total = np.bincount(pos[mine], value[mine])
        at = np.flatnonzero(total)
        out[int(s)] = (at, total[at])
    return out


def dense(totals: dict[int, tuple], slot: int, size: int) -> np.ndarray:
    out = np.zeros(size)
    if slot in totals:
        pos, value = totals[slot]
        out[pos] = value
    return out
