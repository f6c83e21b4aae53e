"""The flagship query: a cohort of order lines prepared and split in one lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.inputs import LINE_KEY, table
from riskframe.functions.recode import lookup, ordinal_levels, recode_binary, recode_ordinal
from riskframe.operators.features import minmax_scale
from riskframe.operators.split import in_test

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
REGION_OF = {f"NATION_{i}": REGIONS[i % 5] for i in range(25)}


def prepared_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # scaled before the joins: the ranges come from one narrow scan of the lines
    lines = minmax_scale(lines, ["l_quantity", "l_extendedprice"])
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(
        *LINE_KEY,
        recode_binary("o_orderstatus", "F", "O").alias("filled"),
        recode_ordinal("o_orderpriority", ordinal_levels(PRIORITIES)).alias("priority"),
        lookup("n_name", REGION_OF).alias("region"),
        F.col("l_quantity_scaled").alias("quantity_scaled"),
        F.col("l_extendedprice_scaled").alias("price_scaled"),
        F.when(in_test(LINE_KEY, 0.3, 25), "test").otherwise("train").alias("split"),
    )


def cohort_report(cohort: DataFrame) -> DataFrame:
    return cohort.groupBy("split", "filled", "region").agg(
        F.count("*").alias("n"),
        F.avg("priority").alias("mean_priority"),
        F.avg("quantity_scaled").alias("mean_quantity"),
        F.avg("price_scaled").alias("mean_price"),
    )
