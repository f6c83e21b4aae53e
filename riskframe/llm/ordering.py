"""Places of rows within their groups, for any size of a group, without one task for a group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.shared import materialize

GROUP, PLACE = "group", "place"


def text_key(value: Column) -> Column:
    """Text that tells values apart, null first, and otherwise sorts as the values' text does."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task and the row's place within the run of equal groups of this task."""
    task, last, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        places = []
        for g, size in _lengths(batch.column(GROUP)):
            n = n if g == last else 0
            places.append(pa.array(range(n, n + size), pa.int64()))
            last, n = g, n + size
        columns = [*batch.columns, pa.array([task] * batch.num_rows, pa.int64()), pa.concat_arrays(places)]
        yield pa.record_batch(columns, [*batch.schema.names, "task", "run_place"])


def _lengths(groups: pa.Array) -> list[tuple[str, int]]:
    """(value, length) of the runs of equal values."""
    runs = pc.run_end_encode(groups)
    ends = runs.run_ends.to_pylist()
    return [(v, b - a) for v, a, b in zip(runs.values.to_pylist(), [0, *ends], ends)]


def numbered(rows: DataFrame, order: Sequence[Column | str], label: str) -> DataFrame:
    """Adds ``place``: 0, 1, ... within each ``group`` (text, not null) by ``order``; written.

    Ranges of (group, order) go to the tasks, so a large group lies in many of them.  Every task
    numbers its own rows; a group that began in an earlier task is moved by what lies there, and
    a task has at most one such group, so the table of moves is no longer than the tasks are many.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, GROUP, *order).sortWithinPartitions(GROUP, *order)
    schema = T.StructType([*dealt.schema.fields, T.StructField("task", T.LongType()), T.StructField("run_place", T.LongType())])
    runs = materialize(dealt.mapInArrow(_runs, schema), label)
    sizes = runs.groupBy(GROUP, "task").agg((F.max("run_place") + 1).alias("n"))
    before = Window.partitionBy(GROUP).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    moves = sizes.select(GROUP, "task", F.sum("n").over(before).alias("moved")).where("moved > 0")
    return (
        runs.join(F.broadcast(moves), [GROUP, "task"], "left")
        .withColumn(PLACE, F.col("run_place") + F.coalesce("moved", F.lit(0)))
        .drop("task", "run_place", "moved")
    )
