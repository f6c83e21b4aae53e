"""Keys, de-duplication, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.cohort import cohort_report, prepared_orders
from catalogue.inputs import LINE_KEY, key_sql, rounded, table, unit_sql
from riskframe.operators import split as P

COPY_COLS = ["l_returnflag", "l_linestatus", "l_linenumber"]


def row_key_copies(spark, sf):
    """Keys of a projection with many equal rows: content hash and copy number."""
    return P.with_row_key(table(spark, sf, "lineitem").select(*COPY_COLS))


def row_key_natural(spark, sf):
    return P.with_row_key(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])


def latest_per_key(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return P.latest_per_key(events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


def strata_fractions(spark, sf):
    return P.strata_fractions(table(spark, sf, "orders"), "o_orderstatus", 0.3)


def _split(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    return P.split_stratified(orders, "o_orderstatus", 0.3, 25, ["o_orderkey"])


def split_test(spark, sf):
    return _split(spark, sf)[1]


def split_train(spark, sf):
    return _split(spark, sf)[0]


def split_train_by_anti_join(spark, sf):
    """Train rows as everything whose key is not in the test frame."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    return P.without(orders, _split(spark, sf)[1], ["o_orderkey"])


def split_exact_test(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return P.split_exact(events, 0.3, 123, ["event_id"])[1]


def split_exact_without_key(spark, sf):
    """Exact split of rows without a unique key, by way of a row key."""
    keyed = P.with_row_key(table(spark, sf, "lineitem").select(*COPY_COLS))
    train, test = P.split_exact(keyed, 0.3, 123)
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides.groupBy("side", *COPY_COLS).agg(F.count("*").alias("n"))


def sample_fixed(spark, sf):
    return P.sample_n(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 100, 25, ["o_orderkey"])


def union_duplicates(spark, sf):
    train, test = _split(spark, sf)
    whole = P.union_all(P.union_all(train, test), test)
    return whole.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def study_split(spark, sf):
    """The preparation of a cohort in one lineage: recodes, lookup, scaling, split."""
    return rounded(cohort_report(prepared_orders(spark, sf)))


_ORDER_TEST = unit_sql(["o_orderkey"], 25) + " < 0.3"
_COPIES = (
    f"SELECT {', '.join(COPY_COLS)}, md5({key_sql(COPY_COLS)}) || '-' || "
    f"row_number() OVER (PARTITION BY {', '.join(COPY_COLS)}) AS row_key FROM lineitem"
)

QUERIES = {
    "row_key_copies": (row_key_copies, _COPIES),
    "row_key_natural": (
        row_key_natural, f"SELECT o_orderkey, o_custkey, md5({key_sql(['o_orderkey'])}) AS row_key FROM orders"
    ),
    "latest_per_key": (
        latest_per_key,
        "SELECT user_id, event_id, event_type, value FROM events "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    ),
    "strata_fractions": (strata_fractions, "SELECT DISTINCT o_orderstatus, 0.3::DOUBLE AS fraction FROM orders"),
    "split_test": (split_test, f"SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE {_ORDER_TEST}"),
    "split_train": (split_train, f"SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE NOT {_ORDER_TEST}"),
    "split_train_by_anti_join": (
        split_train_by_anti_join,
        "SELECT o_orderkey, o_orderstatus, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders t "
        f"WHERE t.o_orderkey = o.o_orderkey AND {unit_sql(['t.o_orderkey'], 25)} < 0.3)",
    ),
    "split_exact_test": (
        split_exact_test,
        f"SELECT event_id, event_type FROM events QUALIFY row_number() OVER (ORDER BY md5(concat({key_sql(['event_id'])}, ':123'))) "
        "<= ceil(0.3 * (SELECT count(*) FROM events))",
    ),
    "split_exact_without_key": (
        split_exact_without_key,
        f"WITH k AS ({_COPIES}), r AS (SELECT *, row_number() OVER (ORDER BY md5({key_sql(['row_key'])} || ':123')) AS rn FROM k) "
        "SELECT CASE WHEN rn <= ceil(0.3 * (SELECT count(*) FROM lineitem)) THEN 'test' ELSE 'train' END AS side, "
        f"{', '.join(COPY_COLS)}, count(*) AS n FROM r GROUP BY ALL",
    ),
    "sample_fixed": (
        sample_fixed, f"SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(concat({key_sql(['o_orderkey'])}, ':25')) LIMIT 100"
    ),
    "union_duplicates": (
        union_duplicates,
        f"SELECT o_orderstatus, count(*) + count(*) FILTER ({_ORDER_TEST}) AS n FROM orders GROUP BY 1",
    ),
    "study_split": (
        study_split,
        "WITH c AS (SELECT *, CASE WHEN " + unit_sql(LINE_KEY, 25)
        + " < 0.3 THEN 'test' ELSE 'train' END AS split, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS filled, "
        "r_name AS region, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority FROM lineitem "
        "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
        "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), "
        "b AS (SELECT min(l_quantity) AS ql, max(l_quantity) AS qh, min(l_extendedprice) AS pl, max(l_extendedprice) AS ph FROM c) "
        "SELECT split, filled, region, count(*) AS n, round(avg(priority), 6) AS mean_priority, "
        "round(avg((l_quantity - ql) / (qh - ql)), 6) AS mean_quantity, "
        "round(avg((l_extendedprice - pl) / (ph - pl)), 6) AS mean_price FROM c, b GROUP BY ALL",
    ),
}
