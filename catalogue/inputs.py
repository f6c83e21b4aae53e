"""Inputs shared by the registered queries, as DataFrames and as SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.keys import hash_unit

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with a 0/1 label y that follows the quantity up to a per-row noise."""
    noise = hash_unit(LINE_KEY)
    lines = table(spark, sf_dir, "lineitem")
    return lines.withColumn("y", (F.col("l_quantity") + 20 * noise > 35).cast("int"))


def wide_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its order, customer and part."""
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded, for comparison across engines."""
    doubles = {c for c, t in df.dtypes if t == "double"}
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if c in doubles else F.col(f"`{c}`") for c in df.columns])


def key_sql(cols: Sequence[str]) -> str:
    """SQL of the text of a key."""
    return "concat_ws('|', " + ", ".join(f"coalesce(len({c}::VARCHAR) || ':' || {c}::VARCHAR, '~')" for c in cols) + ")"


def unit_sql(cols: Sequence[str], seed: int | None = None) -> str:
    """SQL of the hash-uniform of a key."""
    text = key_sql(cols) if seed is None else f"concat({key_sql(cols)}, ':{seed}')"
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0)"


LINE_STUDY = "study AS (SELECT *, CAST(l_quantity + 20 * " + unit_sql(LINE_KEY) + " > 35 AS INTEGER) AS y FROM lineitem)"

WIDE_STUDY = (
    "wide AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"
)
