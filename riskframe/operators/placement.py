"""Placement of rows that many passes will read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


TASK = "_task"


def with_task(df: DataFrame) -> DataFrame:
    return df.withColumn(TASK, F.spark_partition_id())


def occupied_partitions() -> Column:
    """Aggregate over ``with_task`` rows: number of tasks that hold any; it goes along in a
    job that runs anyway."""
    return F.approx_count_distinct(TASK)


@dataclass(frozen=True)
class Kept:
    """Persisted rows and an upper bound of the tasks one pass over them runs."""

    df: DataFrame
    tasks: int

    def release(self) -> None:
        self.df.unpersist()


ROWS_PER_TASK = 20_000  # folded rows that make a Python task worth its start


def keep_for_passes(df: DataFrame, occupied: int) -> Kept:
    """Persist.  ``occupied`` is the number of tasks that hold rows: input in fewer pieces than
    there are cores is spread over them first, any other input stays where it is and costs no
    shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if occupied < cores:
        df, tasks = df.repartition(cores), cores
    else:
        tasks = 2 * occupied  # the sketch is exact to a few percent
    return Kept(df.persist(StorageLevel.MEMORY_AND_DISK), tasks)


def keep_folded(df: DataFrame, rows: int) -> Kept:
    """Persist the result of a shuffle that holds about ``rows`` rows, in as few partitions as
    they need; they are dealt anew, so the work before keeps all its tasks."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(partitions, -(-rows // ROWS_PER_TASK)))
    return Kept(df.repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK), tasks)
