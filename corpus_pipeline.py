"""The corpus pipeline: five stages over ``documents``, each written and read again.

A stage gets (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of ``documents``.  Decisions are made for rows, not for ids: null and repeated
ids are rows like any other.  The result of a stage has to be written before the next one is
called, as ``run`` does: a stage first discards the working tables of the one before.
"""

from __future__ import annotations

import functools
import gc
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import cotraining, decontaminate, jaccard_join, mixture, training_order
from riskframe.llm.shared import materialize, table
from riskframe.sources.scratch import discard, recorded


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


ROW = "__row"
_left: list[str] = []  # working tables of the stage before


def _stage(work: Callable) -> Callable:
    """Discards what the stage before left, unless ``docs`` still reads it, and notes what this one writes."""

    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        gone = [path for path in _left if not any(path in file for file in read)]
        _left[:] = [path for path in _left if path not in gone]
        discard(spark, gone)
        gc.collect()
        spark._jvm.System.gc()  # so that Spark's cleaner drops the shuffles of that stage, too
        with recorded() as paths:
            out = work(spark, docs, sf_dir)
        _left.extend(paths)
        return out

    return run_stage


def _rows(docs: DataFrame, label: str) -> DataFrame:
    """The input of a stage with a number for every row.  Rows of a plain scan of files are
    numbered by their places there, the same in every scan; others are written with their numbers."""
    numbered = docs.withColumn(ROW, F.monotonically_increasing_id())
    scan = docs._jdf.queryExecution().analyzed().children().isEmpty() and docs.inputFiles()
    return numbered if scan else materialize(numbered, f"pipeline-rows-{label}")


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go: low quality or toxic."""
    model = cotraining.fit_quality(docs, cotraining.quality_labels(table(spark, sf_dir, "labels")))
    return cotraining.score_quality(docs, model, "__").where("__kept").select(*_columns(docs))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents tied by four-word shingles with a similarity of 0.85 or more, one row stays:
    that with the smallest id, one without an id only where none has one."""
    rows = _rows(docs, "near")
    found = jaccard_join.jaccard_components(rows, key=ROW).join(rows.select(ROW, "doc_id"), ROW)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", ROW))
    stays = found.groupBy("component_id").agg(first.alias("first")).select(F.col(f"first.{ROW}").alias(ROW))
    return rows.join(stays, ROW, "left_semi").select(*_columns(docs))


@_stage
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window that is 80 % a benchmark item go."""
    rows = _rows(docs, "leaks")
    found = decontaminate.find_leaks(rows, table(spark, sf_dir, "benchmark"), key=ROW)
    return rows.join(found.select(ROW), ROW, "left_anti").select(*_columns(docs))


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: 0 to 3 times."""
    rows = _rows(docs, "mix")
    place = F.concat_ws(":", "doc_id", F.md5(F.coalesce("text", F.lit(""))))
    copies = mixture.mix(rows.withColumn("__place", place), key=ROW, position="__place").where("copies > 0")
    taken = rows.join(copies.select(ROW, F.col("copies").alias("__copies")), ROW)
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*_columns(docs))


@_stage
def ordered(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order, read back from their shards."""
    with recorded() as paths:
        sequences = training_order.op9(spark, sf_dir, docs)
    discard(spark, [path for path in paths if "/shards-" not in path])  # the shards hold all of it
    return sequences


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("mixture", mixed),
    ("training_order", ordered),
]

# Fitted models, and the tokenizer, are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; of the last one the rows read back from its shards, which are written already."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        with recorded() as paths:
            docs = materialize(out, f"pipeline-{name}")
        discard(spark, before)
        before = paths
    return STAGES[-1][1](spark, docs, sf_dir)
