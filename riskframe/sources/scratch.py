"""Shared scratch space for tables that cut a long lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_recorders: list[list[str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.  Only a session inside one process, as in tests,
    gets a temporary folder where it is unset, for the rest of the session; on a cluster every
    machine would write to a folder of its own, so there its absence is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="riskframe-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/riskframe/{label}-{uuid.uuid4().hex}"
    for paths in _recorders:
        paths.append(path)
    return path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Lists the tables that are written meanwhile, to be discarded once they are superseded."""
    paths: list[str] = []
    _recorders.append(paths)
    try:
        yield paths
    finally:
        _recorders[:] = [held for held in _recorders if held is not paths]


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Removes tables of this module that nothing reads any more."""
    for path in paths:
        if "/riskframe/" in path:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: later plans start at these files, so a
    lost executor re-reads them and never repeats the work before."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
