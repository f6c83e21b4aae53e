"""Sources, sinks, scaling, cleaning and encoding."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalogue.inputs import rounded, table
from riskframe.operators import features as S
from riskframe.operators.design import design_frame, dummy_columns, factor, factor_table, factors
from riskframe.sources.scratch import scratch_path
from riskframe.sources.tables import CORRUPT, quarantine, read_table, write_table

ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def csv_inferred(spark, sf):
    path = scratch_path(spark, "csv")
    write_table(table(spark, sf, "customer"), path, fmt="csv")
    return read_table(spark, path)


def _order_lines(spark, sf):
    """Orders as CSV text in which status P spoils the customer number and the highest
    priority adds a field too many."""
    customer = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
    extra = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("surplus"))
    line = F.concat_ws(",", "o_orderkey", customer, "o_orderstatus", F.col("o_totalprice").cast("string"), extra)
    path = scratch_path(spark, "lines")
    table(spark, sf, "orders").select(line).write.text(path)
    return read_table(spark, path, schema=ORDER_SCHEMA, corrupt_col=CORRUPT, header=False)


def csv_quarantine_good(spark, sf):
    return quarantine(_order_lines(spark, sf))[0]


def csv_quarantine_bad(spark, sf):
    return quarantine(_order_lines(spark, sf))[1].select("o_orderkey", "o_custkey", "o_orderstatus")


def csv_quarantine_required(spark, sf):
    good, bad = quarantine(_order_lines(spark, sf), required=["o_custkey"])
    sides = good.select(F.lit("good").alias("side")).unionByName(bad.select(F.lit("bad").alias("side")))
    return sides.groupBy("side").agg(F.count("*").alias("n"))


def parquet_partitioned(spark, sf):
    path = scratch_path(spark, "orders")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    write_table(orders, path, partition_by=["o_orderstatus"])
    return read_table(spark, path, fmt="parquet").filter(F.col("o_orderstatus") != "P")


def csv_single_file(spark, sf):
    path = scratch_path(spark, "report")
    report = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    write_table(report, path, fmt="csv", single_file=True)
    return read_table(spark, path, schema="l_returnflag string, l_linestatus string, n bigint")


def vector_assemble(spark, sf):
    orders = S.assemble(table(spark, sf, "orders"), ["o_orderkey", "o_totalprice"], "v")
    return orders.select("o_orderkey", F.round(vector_to_array("v")[1], 2).alias("second"))


def scale_minmax(spark, sf):
    lines = S.minmax_scale(table(spark, sf, "lineitem").withColumn("flat", F.lit(7.0)), [*LINE_NUMBERS, "flat"])
    scaled = [f"{c}_scaled" for c in LINE_NUMBERS]
    return rounded(
        lines.groupBy("l_returnflag").agg(*[F.avg(c).alias(c) for c in scaled], F.avg("flat_scaled").alias("flat_scaled"))
    )


def scale_fit_on_subset(spark, sf):
    orders = table(spark, sf, "orders")
    scaled = S.minmax_scale(orders, ["o_totalprice"], fit_on=orders.filter(F.col("o_orderstatus") == "F"))
    return rounded(scaled.select("o_orderkey", "o_totalprice_scaled"), 5)


def winsorize_exact(spark, sf):
    lines = S.winsorize(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], exact=True)
    return rounded(
        lines.groupBy("l_linestatus").agg(
            *[F.min(c).alias(f"min_{c}") for c in ("l_extendedprice", "l_quantity")],
            *[F.max(c).alias(f"max_{c}") for c in ("l_extendedprice", "l_quantity")],
            *[F.avg(c).alias(f"avg_{c}") for c in ("l_extendedprice", "l_quantity")],
        ),
        4,
    )


def winsorize_sketch(spark, sf):
    """Share of clamped rows by the sketched bounds, to the two digits that the sketch fixes."""
    lines = table(spark, sf, "lineitem").select("l_extendedprice", F.col("l_extendedprice").alias("raw"))
    clamped = S.winsorize(lines, ["l_extendedprice"])
    return clamped.agg(
        F.count("*").alias("n"),
        F.round(F.avg((F.col("l_extendedprice") != F.col("raw")).cast("double")), 2).alias("clamped_share"),
    )


def impute_mean(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("gap", F.nullif(F.col("l_discount"), F.lit(0.0)))
    return rounded(S.impute(lines, ["gap"]).groupBy("gap_imp").agg(F.count("*").alias("n")))


def impute_mode(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("gap", F.nullif(F.col("l_discount"), F.lit(0.0)))
    return rounded(S.impute(lines, ["gap"], "mode").groupBy("gap_imp").agg(F.count("*").alias("n")))


def impute_median(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("gap", F.nullif(F.col("l_discount"), F.lit(0.0)))
    return rounded(S.impute(lines, ["gap"], "median").groupBy("gap_imp").agg(F.count("*").alias("n")))


def category_dictionary_wide(spark, sf):
    """Columns with very many labels."""
    return S.category_index(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])


def index_categories_wide(spark, sf):
    """A dictionary that stays a table: one label for every order."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    indexed = S.index_categories(lines, ["l_orderkey"])
    return indexed.select("l_orderkey", "l_linenumber", F.col("l_orderkey_idx").cast("int").alias("order_idx"))


def factor_levels_table(spark, sf):
    return factor_table(table(spark, sf, "orders"), ["o_orderpriority", "o_custkey"])


def category_dictionary(spark, sf):
    orders = table(spark, sf, "orders")
    return S.category_index(orders, ["o_orderstatus", "o_orderpriority"])


def index_categories(spark, sf):
    part = S.index_categories(table(spark, sf, "part"), ["p_type"])
    return part.select("p_partkey", F.col("p_type_idx").cast("int").alias("type_idx"))


def one_hot_vectors(spark, sf):
    orders = S.index_categories(table(spark, sf, "orders"), ["o_orderstatus"], order="alphabetAsc")
    hot = S.one_hot(orders, ["o_orderstatus_idx"]).withColumn("a", vector_to_array("o_orderstatus_idx_oh"))
    slots = {f"slot{i}": F.col("a")[i].cast("int") for i in range(4)}
    return hot.select("o_orderkey", *[v.alias(k) for k, v in slots.items()])


def factor_levels(spark, sf):
    orders = table(spark, sf, "orders")
    levels = factor(orders, "o_orderpriority", baseline="3-MEDIUM")
    rows = [(i, v) for i, v in enumerate(levels)]
    return spark.createDataFrame(rows, "position int, level string")


def dummy_all_levels(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return dummy_columns(orders, factors(orders, ["o_orderstatus"]))


def design_treatment(spark, sf):
    orders = table(spark, sf, "orders")
    levels = factors(orders, ["o_orderpriority"])
    coded = design_frame(orders, ["o_totalprice", "o_orderpriority"], levels, keep=["o_orderkey"])
    return rounded(coded, 2)


def clean_fitted(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("gap", F.nullif(F.col("l_discount"), F.lit(0.0)))
    fitted = S.clean_pipeline(["gap"], ["l_returnflag"], order="alphabetAsc").fit(lines)
    out = fitted.transform(lines)
    return rounded(
        out.groupBy(F.col("l_returnflag_idx").cast("int").alias("idx")).agg(
            F.avg("gap_imp").alias("mean_gap"), F.sum(vector_to_array("l_returnflag_oh")[0]).cast("long").alias("n_a")
        )
    )


_BAD = "(o_orderstatus = 'P' OR o_orderpriority = '1-URGENT')"
_CLAMP = ", ".join(
    f"round({f}(least(greatest({c}, {c}_lo), {c}_hi)), 4) AS {f}_{c}"
    for f in ("min", "max", "avg") for c in ("l_extendedprice", "l_quantity")
)
_BOUNDS = ", ".join(
    f"quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi" for c in ("l_extendedprice", "l_quantity")
)
_RANGES = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in LINE_NUMBERS)

QUERIES = {
    "csv_inferred": (csv_inferred, "SELECT * FROM customer"),
    "csv_quarantine_good": (
        csv_quarantine_good, f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE NOT {_BAD}"
    ),
    "csv_quarantine_bad": (
        csv_quarantine_bad,
        "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, o_orderstatus "
        f"FROM orders WHERE {_BAD}",
    ),
    "csv_quarantine_required": (
        csv_quarantine_required,
        "SELECT CASE WHEN o_orderstatus = 'P' THEN 'bad' ELSE 'good' END AS side, count(*) AS n FROM orders GROUP BY 1",
    ),
    "parquet_partitioned": (
        parquet_partitioned, "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'"
    ),
    "csv_single_file": (csv_single_file, "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2"),
    "vector_assemble": (vector_assemble, "SELECT o_orderkey, round(o_totalprice, 2) AS second FROM orders"),
    "scale_minmax": (
        scale_minmax,
        f"WITH r AS (SELECT {_RANGES} FROM lineitem) SELECT l_returnflag, "
        + ", ".join(f"round(avg(({c} - lo_{c}) / (hi_{c} - lo_{c})), 6) AS {c}_scaled" for c in LINE_NUMBERS)
        + ", 0.5::DOUBLE AS flat_scaled FROM lineitem, r GROUP BY 1",
    ),
    "scale_fit_on_subset": (
        scale_fit_on_subset,
        "WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders WHERE o_orderstatus = 'F') "
        "SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 5) AS o_totalprice_scaled FROM orders, r",
    ),
    "winsorize_exact": (
        winsorize_exact,
        f"WITH b AS (SELECT {_BOUNDS} FROM lineitem) SELECT l_linestatus, {_CLAMP} FROM lineitem, b GROUP BY 1",
    ),
    "winsorize_sketch": (
        winsorize_sketch,
        f"WITH b AS (SELECT {_BOUNDS} FROM lineitem) SELECT count(*) AS n, round(avg(CAST(l_extendedprice < l_extendedprice_lo "
        "OR l_extendedprice > l_extendedprice_hi AS INTEGER)), 2) AS clamped_share FROM lineitem, b",
    ),
    "impute_mean": (
        impute_mean,
        "WITH m AS (SELECT avg(nullif(l_discount, 0.0)) AS v FROM lineitem) "
        "SELECT round(coalesce(nullif(l_discount, 0.0), v), 6) AS gap_imp, count(*) AS n FROM lineitem, m GROUP BY 1",
    ),
    "impute_mode": (
        impute_mode,
        "WITH m AS (SELECT l_discount AS v FROM lineitem WHERE l_discount <> 0 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) "
        "SELECT round(coalesce(nullif(l_discount, 0.0), v), 6) AS gap_imp, count(*) AS n FROM lineitem, m GROUP BY 1",
    ),
    "impute_median": (
        impute_median,
        "WITH m AS (SELECT quantile_cont(nullif(l_discount, 0.0), 0.5) AS v FROM lineitem) "
        "SELECT round(coalesce(nullif(l_discount, 0.0), v), 6) AS gap_imp, count(*) AS n FROM lineitem, m GROUP BY 1",
    ),
    "category_dictionary_wide": (
        category_dictionary_wide,
        "WITH c AS (SELECT 'l_orderkey' AS \"column\", l_orderkey::VARCHAR AS label, count(*) AS n FROM lineitem GROUP BY 2 "
        "UNION ALL SELECT 'l_partkey', l_partkey::VARCHAR, count(*) FROM lineitem GROUP BY 2) SELECT *, "
        "CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, label) - 1 AS INTEGER) AS idx FROM c",
    ),
    "index_categories_wide": (
        index_categories_wide,
        "WITH c AS (SELECT l_orderkey, CAST(row_number() OVER (ORDER BY count(*) DESC, l_orderkey::VARCHAR) - 1 AS INTEGER) AS order_idx "
        "FROM lineitem GROUP BY l_orderkey) SELECT l_orderkey, l_linenumber, order_idx FROM lineitem JOIN c USING (l_orderkey)",
    ),
    "factor_levels_table": (
        factor_levels_table,
        "WITH c AS (SELECT DISTINCT 'o_orderpriority' AS \"column\", o_orderpriority AS level FROM orders "
        "UNION ALL SELECT DISTINCT 'o_custkey', o_custkey::VARCHAR FROM orders) "
        "SELECT \"column\", row_number() OVER (PARTITION BY \"column\" ORDER BY level) - 1 AS position, level FROM c",
    ),
    "category_dictionary": (
        category_dictionary,
        "WITH c AS (SELECT 'o_orderstatus' AS \"column\", o_orderstatus AS label, count(*) AS n FROM orders GROUP BY 2 "
        "UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2) SELECT *, "
        "CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, label) - 1 AS INTEGER) AS idx FROM c",
    ),
    "index_categories": (
        index_categories,
        "WITH c AS (SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS INTEGER) AS type_idx "
        "FROM part GROUP BY p_type) SELECT p_partkey, type_idx FROM part JOIN c USING (p_type)",
    ),
    "one_hot_vectors": (
        one_hot_vectors,
        "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS slot0, CAST(o_orderstatus = 'O' AS INTEGER) AS slot1, "
        "CAST(o_orderstatus = 'P' AS INTEGER) AS slot2, 0 AS slot3 FROM orders",
    ),
    "factor_levels": (
        factor_levels,
        "SELECT CAST(row_number() OVER (ORDER BY level <> '3-MEDIUM', level) - 1 AS INTEGER) AS position, level "
        "FROM (SELECT DISTINCT o_orderpriority AS level FROM orders)",
    ),
    "dummy_all_levels": (
        dummy_all_levels,
        "SELECT o_orderkey, "
        + ", ".join(f"CAST(o_orderstatus = '{v}' AS INTEGER) AS o_orderstatus{v}" for v in "FOP")
        + " FROM orders",
    ),
    "design_treatment": (
        design_treatment,
        "SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, "
        + ", ".join(
            f"CAST(o_orderpriority = '{v}' AS DOUBLE) AS \"o_orderpriority{v}\""
            for v in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
        )
        + " FROM orders",
    ),
    "clean_fitted": (
        clean_fitted,
        "WITH m AS (SELECT avg(nullif(l_discount, 0.0)) AS v FROM lineitem) SELECT "
        "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS idx, "
        "round(avg(coalesce(nullif(l_discount, 0.0), v)), 6) AS mean_gap, "
        "CAST(count(*) FILTER (l_returnflag = 'A') AS BIGINT) AS n_a FROM lineitem, m GROUP BY 1",
    ),
}
