"""Lookups of labels in tables of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted, require_columns

BROADCAST_BYTES = 64 << 20  # size of a dictionary up to which every task gets all of it
SPREAD = 64  # parts into which the rows of a frequent label are spread
FREQUENT = 0.005  # share of the rows from which a label counts as frequent


def dimension_join(df: DataFrame, col: str, table: DataFrame, key: str, values: Sequence[str], hot: Sequence[str]) -> DataFrame:
    """Left join of ``values`` of a table with one row per ``key``; rows of the ``hot`` labels, a
    list of bounded length, are spread over parts that each have a copy of their entry."""
    label = quoted(col).cast("string")
    # rows without a label match nothing, so they may lie anywhere
    often = label.isNull() | label.isin(list(hot)) if hot else label.isNull()
    part = F.when(often, F.pmod(F.xxhash64(*[quoted(c) for c in df.columns]), F.lit(SPREAD))).otherwise(0)
    copies = F.when(F.col("_key").isin(list(hot)), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0))) if hot else F.array(F.lit(0))
    entries = table.select(quoted(key).cast("string").alias("_key"), *[quoted(v) for v in values]).withColumn("_part", F.explode(copies.cast("array<long>")))
    rows = df.withColumns({"_label": label, "_share": part.cast("long")})
    joined = rows.join(entries, (F.col("_label") == F.col("_key")) & (F.col("_share") == F.col("_part")), "left")
    return joined.drop("_label", "_share", "_key", "_part")


def lookup_table(df: DataFrame, col: str, table: DataFrame, key: str, value: str, out: str, default: str | None = None) -> DataFrame:
    """Dictionary lookup in a table: a miss gives ``default`` (null unless set), a null stays null.

    A key that stands twice gives its least value.  The size of the table is looked at first: a
    small one goes to every task, a large one is joined with the rows of frequent labels spread.
    """
    require_columns(df, [col])
    entries = table.select(quoted(key).cast("string").alias("_entry"), quoted(value).alias("_found"))
    entries = entries.where(F.col("_entry").isNotNull()).groupBy("_entry").agg(F.min("_found").alias("_found"))
    size = entries.agg(F.sum(F.octet_length("_entry") + F.coalesce(F.octet_length(F.col("_found").cast("string")), F.lit(0)) + 16)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        joined = df.join(F.broadcast(entries), quoted(col).cast("string") == F.col("_entry"), "left").drop("_entry")
    else:
        seen = df.select(quoted(col).cast("string").alias("label")).freqItems(["label"], FREQUENT).first()[0]
        joined = dimension_join(df, col, entries, "_entry", ["_found"], hot=[v for v in seen if v is not None])
    found = F.col("_found") if default is None else F.when(quoted(col).isNotNull(), F.coalesce("_found", F.lit(default)))
    return joined.withColumn(out, found).drop("_found") if out != "_found" else joined
