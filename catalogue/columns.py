"""Column surgery and recodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.inputs import rounded, table
from riskframe.functions import columns as C
from riskframe.functions import recode as R
from riskframe.operators.features import assemble
from riskframe.operators.lookup import lookup_table
from riskframe.operators.profile import group_keys

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
# first three types only: the other three labels are the misses of the mapping
TYPE_CODES = {"ECONOMY": 1, "SMALL": 2, "MEDIUM": 3}
REGION_OF = {f"NATION_{i}": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"][i % 5] for i in range(25)}
NAME_RULES = [("startswith", "small", "Small goods"), ("contains", "bolt", "Fasteners"), ("equals", "red ring", "Rings")]
EVENT_RULES = [("equals", "purchase", "Buys"), ("startswith", "sign", "Joins"), ("contains", "rr", "Fails")]
URL_RULES = [("startswith", "https://m.", "mobile"), ("contains", "blog.", "blog"), ("startswith", "https", "secure")]


def _case(col: str, mapping: dict, default: str = "NULL") -> str:
    quote = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {quote(v)}" for k, v in mapping.items()) + f" ELSE {default} END"


def _rule_case(col: str, rules) -> str:
    tests = {"equals": "{c} = '{t}'", "contains": "contains({c}, '{t}')", "startswith": "starts_with({c}, '{t}')"}
    return "CASE " + " ".join(f"WHEN {tests[k].format(c=col, t=t)} THEN '{v}'" for k, t, v in rules) + f" ELSE {col} END"


def columns_drop(spark, sf):
    return table(spark, sf, "supplier").drop("s_name", "s_acctbal")


def columns_drop_matching(spark, sf):
    return C.drop_matching(table(spark, sf, "part"), r"^p_(name|brand)")


def columns_select_ordered(spark, sf):
    return table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_nationkey")


def columns_sorted_features(spark, sf):
    part = table(spark, sf, "part")
    names = C.feature_columns(part, ["p_name", "p_retailprice"])
    return C.align(part, names)


def columns_required(spark, sf):
    return C.require_columns(table(spark, sf, "labels"), ["doc_id", "quality", "toxic"])


def columns_filter_equal(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


def columns_head(spark, sf):
    frame = C.head(table(spark, sf, "orders"), 25, [F.col("o_totalprice").desc(), "o_orderkey"])
    return frame.select("o_orderkey", "o_totalprice")


def columns_rename_matching(spark, sf):
    renamed = C.rename_matching(table(spark, sf, "customer"), [("^c_", "customer."), (r"\.", "_")])
    return renamed.select("customer_custkey", "customer_mktsegment")


def columns_features_target(spark, sf):
    return C.features_target(table(spark, sf, "labels"), "toxic")


def columns_missing(spark, sf):
    """Keys of one table that the other does not have: documents without a label."""
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return documents.select("doc_id").join(labels.select("doc_id"), "doc_id", "left_anti")


def recode_binary(spark, sf):
    lines = table(spark, sf, "lineitem")
    return (
        lines.select(
            R.recode_binary("l_linestatus", "O", "F").alias("open"),
            R.recode_binary("l_returnflag", "R", "N").alias("returned"),
        )
        .groupBy("open", "returned")
        .agg(F.count("*").alias("n"))
    )


def recode_ordinal(spark, sf):
    orders = table(spark, sf, "orders")
    code = R.recode_ordinal("o_orderpriority", R.ordinal_levels(PRIORITIES), unmatched="error")
    return orders.select("o_orderkey", code.alias("priority"))


def recode_ordinal_misses(spark, sf):
    return table(spark, sf, "part").select("p_partkey", R.recode_ordinal("p_type", TYPE_CODES).alias("type_code"))


def recode_rules_names(spark, sf):
    return table(spark, sf, "part").select("p_partkey", R.recode_rules("p_name", NAME_RULES).alias("kind"))


def recode_rules_events(spark, sf):
    events = table(spark, sf, "events")
    return events.groupBy(R.recode_rules("event_type", EVENT_RULES).alias("kind")).agg(F.count("*").alias("n"))


def recode_rules_urls(spark, sf):
    kind = R.recode_rules("url", URL_RULES, default=F.lit("other"))
    return table(spark, sf, "pages").select("page_id", kind.alias("kind"))


def recode_greatest(spark, sf):
    lines = table(spark, sf, "lineitem")
    # a discount of zero counts as absent, so that nulls take part
    discount = F.nullif(F.col("l_discount"), F.lit(0.0))
    top = R.greatest_of(discount, "l_tax").alias("top")
    return lines.groupBy(top).agg(F.count("*").alias("n"))


def recode_lookup(spark, sf):
    nation = table(spark, sf, "nation")
    return table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", R.lookup("n_name", REGION_OF).alias("region")
    )


def recode_lookup_default(spark, sf):
    part = table(spark, sf, "part")
    return part.select("p_partkey", R.lookup("p_type", {"ECONOMY": "Low", "PROMO": "Low"}, default="Other").alias("tier"))


def recode_lookup_table(spark, sf):
    """A dictionary that is a table: the type of every part, by the text of its key."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup_table(lines, "l_partkey", table(spark, sf, "part"), "p_partkey", "p_type", "part_type", default="Other")


def recode_threeway(spark, sf):
    # one status is blanked to null, which must not fall into the catch-all
    status = F.nullif(F.col("l_returnflag"), F.lit("A"))
    lines = table(spark, sf, "lineitem").withColumn("flag", status)
    return lines.groupBy(R.recode_threeway("flag", "R", "X").alias("code")).agg(F.count("*").alias("n"))


def recode_replace_text(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", R.replace_text("o_orderpriority", " ", "_").alias("priority")
    )


def recode_canonical(spark, sf):
    messy = F.concat(F.lit("  "), F.initcap("c_mktsegment"), F.lit(" "))
    return table(spark, sf, "customer").select("c_custkey", R.canonical(messy).alias("segment"))


def recode_replace_values(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return R.replace_values(orders, {"F": "Filled", "O": "Open"}, ["o_orderstatus"])


def recode_bins(spark, sf):
    bins = R.bin_numeric("p_size", [10, 25, 40], ["under10", "10_24", "25_39", "40_plus"])
    return table(spark, sf, "part").groupBy(bins.alias("size_bin")).agg(F.count("*").alias("n"))


def recode_cast(spark, sf):
    """Text after the third character of a nation name parses only where it is a number."""
    nation = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    digits = F.substring("n_name", 8, 2)
    return nation.select("c_custkey", R.cast_to(digits, "int").alias("code"), R.cast_to("n_name", "int").alias("none"))


def recode_unpack_vector(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax")
    vectors = assemble(lines, ["l_quantity", "l_discount", "l_tax"], "v").select("v")
    unpacked = C.unpack_vector(vectors, "v", ["a", "b", "c"])
    return rounded(unpacked.groupBy("b", "c").agg(F.sum("a").alias("a"), F.count("*").alias("n")))


def recode_round(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.round(F.avg("value"), 4).alias("mean4"), F.round(F.max("value"), 2).alias("max2")
    )


def group_list(spark, sf):
    return group_keys(table(spark, sf, "embeddings"), "label")


QUERIES = {
    "columns_drop": (columns_drop, "SELECT s_suppkey, s_nationkey FROM supplier"),
    "columns_drop_matching": (columns_drop_matching, "SELECT p_partkey, p_type, p_size, p_retailprice FROM part"),
    "columns_select_ordered": (columns_select_ordered, "SELECT c_mktsegment, c_custkey, c_nationkey FROM customer"),
    "columns_sorted_features": (columns_sorted_features, "SELECT p_brand, p_partkey, p_size, p_type FROM part"),
    "columns_required": (columns_required, "SELECT doc_id, quality, toxic FROM labels"),
    "columns_filter_equal": (columns_filter_equal, "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'"),
    "columns_head": (columns_head, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25"),
    "columns_rename_matching": (
        columns_rename_matching,
        "SELECT c_custkey AS customer_custkey, c_mktsegment AS customer_mktsegment FROM customer",
    ),
    "columns_features_target": (columns_features_target, "SELECT doc_id, quality, toxic FROM labels"),
    "columns_missing": (columns_missing, "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels"),
    "recode_binary": (
        recode_binary,
        "SELECT CASE l_linestatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 END AS open, "
        "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 0 END AS returned, count(*) AS n FROM lineitem GROUP BY 1, 2",
    ),
    "recode_ordinal": (
        recode_ordinal,
        f"SELECT o_orderkey, {_case('o_orderpriority', R.ordinal_levels(PRIORITIES))} AS priority FROM orders",
    ),
    "recode_ordinal_misses": (
        recode_ordinal_misses, f"SELECT p_partkey, {_case('p_type', TYPE_CODES)} AS type_code FROM part"
    ),
    "recode_rules_names": (recode_rules_names, f"SELECT p_partkey, {_rule_case('p_name', NAME_RULES)} AS kind FROM part"),
    "recode_rules_events": (
        recode_rules_events, f"SELECT {_rule_case('event_type', EVENT_RULES)} AS kind, count(*) AS n FROM events GROUP BY 1"
    ),
    "recode_rules_urls": (
        recode_rules_urls,
        "SELECT page_id, CASE WHEN starts_with(url, 'https://m.') THEN 'mobile' WHEN contains(url, 'blog.') THEN 'blog' "
        "WHEN starts_with(url, 'https') THEN 'secure' ELSE 'other' END AS kind FROM pages",
    ),
    "recode_greatest": (
        recode_greatest, "SELECT greatest(nullif(l_discount, 0.0), l_tax) AS top, count(*) AS n FROM lineitem GROUP BY 1"
    ),
    "recode_lookup": (
        recode_lookup,
        "SELECT c_custkey, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey "
        "LEFT JOIN region ON n_regionkey = r_regionkey",
    ),
    "recode_lookup_default": (
        recode_lookup_default,
        "SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'Low' ELSE 'Other' END AS tier FROM part",
    ),
    "recode_lookup_table": (
        recode_lookup_table,
        "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p_type, 'Other') AS part_type FROM lineitem LEFT JOIN part ON l_partkey = p_partkey",
    ),
    "recode_threeway": (
        recode_threeway,
        "SELECT CASE l_returnflag WHEN 'A' THEN NULL WHEN 'R' THEN 2 ELSE 1 END AS code, count(*) AS n FROM lineitem GROUP BY 1",
    ),
    "recode_replace_text": (
        recode_replace_text, "SELECT o_orderkey, replace(o_orderpriority, ' ', '_') AS priority FROM orders"
    ),
    "recode_canonical": (recode_canonical, "SELECT c_custkey, lower(c_mktsegment) AS segment FROM customer"),
    "recode_replace_values": (
        recode_replace_values,
        "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE o_orderstatus END "
        "AS o_orderstatus, o_orderpriority FROM orders",
    ),
    "recode_bins": (
        recode_bins,
        "SELECT CASE WHEN p_size < 10 THEN 'under10' WHEN p_size < 25 THEN '10_24' WHEN p_size < 40 THEN '25_39' "
        "ELSE '40_plus' END AS size_bin, count(*) AS n FROM part GROUP BY 1",
    ),
    "recode_cast": (
        recode_cast,
        "SELECT c_custkey, TRY_CAST(substr(n_name, 8, 2) AS INTEGER) AS code, TRY_CAST(n_name AS INTEGER) AS none "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey",
    ),
    "recode_unpack_vector": (
        recode_unpack_vector,
        "SELECT round(l_discount, 6) AS b, round(l_tax, 6) AS c, round(sum(l_quantity), 6) AS a, count(*) AS n "
        "FROM lineitem GROUP BY 1, 2",
    ),
    "recode_round": (
        recode_round,
        "SELECT event_type, round(avg(value), 4) AS mean4, round(max(value), 2) AS max2 FROM events GROUP BY 1",
    ),
    "group_list": (group_list, "SELECT label, count(*) AS n FROM embeddings GROUP BY 1"),
}
