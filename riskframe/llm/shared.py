"""Small helpers of the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable
from types import ModuleType
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.sources.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
CUTS = r"[\x20\x09-\x0D]+"


def kept(name: str, key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once per worker process and key.

    Functions of this library travel by value, so the globals of their modules are new in every
    task; what is to outlive a task is kept in a module of its own.
    """
    home = sys.modules.setdefault("riskframe_kept", ModuleType("riskframe_kept")).__dict__
    if name not in home or home[name][0] != key:
        home[name] = (key, make())
    return home[name][1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else, so that every engine agrees."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text, in order; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), CUTS), lambda w: w != "")


def task_count(df: DataFrame, size: Column, per_task: int) -> int:
    """As many tasks as give each about ``per_task`` bytes of ``size``, and never fewer than
    the session's shuffle partitions."""
    total = df.agg(F.sum(size.cast("long")).alias("n")).first()["n"] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // per_task))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of undirected links (a, b), both long.

    Returns one row per linked node: node, component (its smallest reachable node).  Each round
    maps every node to the smallest node beside it and keeps the links between the images, so
    the number of nodes at least halves; the maps are written to shared files and put together
    backwards.  Smallest neighbours are a partial aggregate, so a hub with very many links is
    combined inside the tasks before it is shuffled.  Null ends are dropped.
    """
    rest = materialize(
        edges.select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b"))
        .where("a < b")
        .distinct(),
        f"{label}-links",
    )
    maps: list[DataFrame] = []
    while not rest.isEmpty():
        ends = rest.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        step = materialize(
            ends.groupBy(F.col("e.a").alias("node")).agg(F.min("e.b").alias("to")).select("node", F.least("node", "to").alias("to")),
            f"{label}-map",
        )
        maps.append(step)
        mapped = (
            rest.join(step.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
        )
        rest = materialize(mapped.where("a < b").distinct(), f"{label}-links")
    if not maps:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = maps[-1]
    for step in reversed(maps[:-1]):
        later = found.select(F.col("node").alias("to"), F.col("to").alias("end"))
        found = step.join(later, "to", "left").select("node", F.coalesce("end", "to").alias("to"))
    return found.select("node", F.col("to").alias("component"))
