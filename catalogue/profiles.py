"""Profiles, association and collinearity."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from catalogue.inputs import LINE_STUDY, WIDE_STUDY, line_study, rounded, table, wide_study
from riskframe.operators import association as A
from riskframe.operators import profile as P
from riskframe.operators.design import factors
from riskframe.operators.linear import gvif, ols

LABEL_COLS = ["o_orderstatus", "o_orderpriority", "c_mktsegment", "l_returnflag", "l_linestatus", "p_type"]
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def summary_exact(spark, sf):
    return rounded(P.summarize(table(spark, sf, "lineitem"), [*NUMBERS, "l_returnflag"]), 4)


def summary_sketch(spark, sf):
    """Sketched quartiles are values of the column, so they fall between exact neighbours; the
    SQL compares the statistics that are exact in both modes."""
    summary = P.summarize(table(spark, sf, "lineitem"), NUMBERS, exact=False)
    return rounded(summary.filter(F.col("stat").isin("min", "mean", "max")), 4)


def summary_sketch_ranks(spark, sf):
    """The sketched quartiles themselves, held against their exact ranks."""
    return P.sketch_ranks(table(spark, sf, "lineitem"), NUMBERS).select("column", "stat", "n", "within")


def null_counts(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.nullif("l_discount", F.lit(0.0)).alias("gap"),
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("hole"),
    )
    return rounded(P.null_profile(lines))


def null_positions(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )
    return P.null_cells(orders, ["o_orderkey"])


def distinct_all(spark, sf):
    return P.distinct_values(wide_study(spark, sf), LABEL_COLS)


def crosstab_long(spark, sf):
    return P.crosstab(wide_study(spark, sf), "o_orderpriority", "p_type")


def crosstab_wide(spark, sf):
    return P.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


def value_counts_label(spark, sf):
    return P.value_counts(table(spark, sf, "labels"), ["quality", "toxic"])


def greatest_value(spark, sf):
    return table(spark, sf, "events").agg(F.max("user_id").alias("top"))


def cramers_v_all(spark, sf):
    return rounded(A.cramers_v(wide_study(spark, sf), LABEL_COLS))


def cramers_v_top(spark, sf):
    return rounded(A.top_pairs(A.cramers_v(wide_study(spark, sf), LABEL_COLS), 5))


def cramers_v_top_with_diagonal(spark, sf):
    v = A.cramers_v(wide_study(spark, sf), LABEL_COLS)
    return rounded(P.top_k(v, "v", 10, ["var_a", "var_b"]))


def cramers_v_matrix(spark, sf):
    v = A.cramers_v(wide_study(spark, sf), LABEL_COLS)
    return rounded(A.association_matrix(v, LABEL_COLS))


def ols_one_predictor(spark, sf):
    fit = ols(line_study(spark, sf), "l_extendedprice", ["l_quantity"])
    return rounded(fit.to_df(spark).select("name", "estimate", "std_error"), 4)


def ols_mixed(spark, sf):
    lines = line_study(spark, sf)
    fit = ols(lines, "y", ["l_quantity", "l_returnflag"], factors(lines, ["l_returnflag"]))
    return rounded(fit.to_df(spark).select("name", "estimate"))


def gvif_two(spark, sf):
    return rounded(gvif(line_study(spark, sf), "l_tax", ["l_quantity", "y"]))


def gvif_factor(spark, sf):
    lines = line_study(spark, sf)
    return rounded(gvif(lines, "l_tax", ["l_quantity", "y", "l_returnflag"], factors(lines, ["l_returnflag"])))


def _summary_sql(stats: dict[str, str]) -> str:
    kinds = {c: "double" for c in NUMBERS}
    parts = [
        f"SELECT '{c}' AS \"column\", '{kinds[c]}' AS type, '{s}' AS stat, round({f.format(c=c)}, 4) AS value FROM lineitem"
        for c in NUMBERS
        for s, f in stats.items()
    ]
    return " UNION ALL ".join(parts)


_BASIC = {"min": "min({c})", "mean": "avg({c})", "max": "max({c})"}
_QUARTILES = {n: f"quantile_cont({{c}}, {p})" for p, n in P.QUARTILES.items()}


def _pair_sql(a: str, b: str) -> str:
    return (
        f"SELECT '{a}' AS var_a, '{b}' AS var_b, (SELECT sqrt((sum(n * n / (rn * cn)) - 1) / (least("
        f"(SELECT count(DISTINCT {a}) FROM wide), (SELECT count(DISTINCT {b}) FROM wide)) - 1)) FROM ("
        f"SELECT n::DOUBLE AS n, sum(n) OVER (PARTITION BY a)::DOUBLE AS rn, sum(n) OVER (PARTITION BY b)::DOUBLE AS cn "
        f"FROM (SELECT {a} AS a, {b} AS b, count(*) AS n FROM wide GROUP BY 1, 2))) AS v"
    )


_PAIRS = " UNION ALL ".join(_pair_sql(a, b) for a, b in combinations(LABEL_COLS, 2))
_V = (
    f"WITH {WIDE_STUDY}, up AS ({_PAIRS}), v AS (SELECT var_a, var_b, v FROM up UNION ALL SELECT var_b, var_a, v FROM up "
    "UNION ALL " + " UNION ALL ".join(f"SELECT '{c}', '{c}', 1.0" for c in LABEL_COLS) + ") "
)

# correlations of the design (quantity, y, flag N, flag R) and determinants of its parts
_CORRS = (
    f"WITH {LINE_STUDY}, d AS (SELECT l_quantity AS a, y AS b, CAST(l_returnflag = 'N' AS DOUBLE) AS c, "
    "CAST(l_returnflag = 'R' AS DOUBLE) AS e FROM study), r AS (SELECT corr(a, b) AS ab, corr(a, c) AS ac, corr(a, e) AS ae, "
    "corr(b, c) AS bc, corr(b, e) AS be, corr(c, e) AS ce FROM d), "
)


def _det3(x: str, y: str, z: str) -> str:
    return f"(1 + 2 * {x} * {y} * {z} - {x} * {x} - {y} * {y} - {z} * {z})"


_DET4 = (
    "(1 - ab*ab - ac*ac - ae*ae - bc*bc - be*be - ce*ce + 2*(ab*ac*bc + ab*ae*be + ac*ae*ce + bc*be*ce) "
    "+ ab*ab*ce*ce + ac*ac*be*be + ae*ae*bc*bc - 2*(ab*bc*ce*ae + ab*be*ce*ac + ac*bc*be*ae))"
)

QUERIES = {
    "summary_exact": (
        summary_exact,
        _summary_sql({**_BASIC, **_QUARTILES})
        + " UNION ALL SELECT 'l_returnflag', 'string', 'length', count(*)::DOUBLE FROM lineitem",
    ),
    "summary_sketch": (summary_sketch, _summary_sql(_BASIC)),
    "summary_sketch_ranks": (
        summary_sketch_ranks,
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{stat}' AS stat, count({c}) AS n, TRUE AS within FROM lineitem"
            for c in NUMBERS
            for stat in P.QUARTILES.values()
        ),
    ),
    "null_counts": (
        null_counts,
        "SELECT 'l_orderkey' AS \"column\", 0::BIGINT AS n_null, 0::BIGINT AS n_nan, 0.0::DOUBLE AS null_rate UNION ALL "
        "SELECT 'gap', count(*) FILTER (l_discount = 0), 0, round(avg(CAST(l_discount = 0 AS INTEGER)), 6) FROM lineitem "
        "UNION ALL SELECT 'hole', 0, count(*) FILTER (l_tax = 0), 0 FROM lineitem",
    ),
    "null_positions": (
        null_positions,
        "SELECT o_orderkey, 'status' AS \"column\" FROM orders WHERE o_orderstatus = 'P' UNION ALL "
        "SELECT o_orderkey, 'priority' FROM orders WHERE o_orderpriority = '5-LOW'",
    ),
    "distinct_all": (
        distinct_all,
        f"WITH {WIDE_STUDY} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM wide GROUP BY {c}" for c in LABEL_COLS
        ),
    ),
    "crosstab_long": (
        crosstab_long, f"WITH {WIDE_STUDY} SELECT o_orderpriority, p_type, count(*) AS n FROM wide GROUP BY 1, 2"
    ),
    "crosstab_wide": (
        crosstab_wide,
        "SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS \"F\", "
        "count(*) FILTER (l_linestatus = 'O') AS \"O\" FROM lineitem GROUP BY 1",
    ),
    "value_counts_label": (value_counts_label, "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2"),
    "greatest_value": (greatest_value, "SELECT max(user_id) AS top FROM events"),
    "cramers_v_all": (cramers_v_all, _V + "SELECT var_a, var_b, round(v, 6) AS v FROM v"),
    "cramers_v_top": (
        cramers_v_top,
        _V + "SELECT var_a, var_b, round(v, 6) AS v FROM v WHERE var_a < var_b ORDER BY v.v DESC LIMIT 5",
    ),
    "cramers_v_top_with_diagonal": (
        cramers_v_top_with_diagonal,
        _V + "SELECT var_a, var_b, round(v, 6) AS v FROM v ORDER BY v.v DESC, var_a, var_b LIMIT 10",
    ),
    "cramers_v_matrix": (
        cramers_v_matrix,
        _V + "SELECT var_a, " + ", ".join(f"round(max(v) FILTER (var_b = '{c}'), 6) AS {c}" for c in LABEL_COLS)
        + " FROM v GROUP BY 1",
    ),
    "ols_one_predictor": (
        ols_one_predictor,
        "WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a, "
        "regr_sxx(l_extendedprice, l_quantity) AS sxx, avg(l_quantity) AS m, count(*) AS n, "
        "(1 - regr_r2(l_extendedprice, l_quantity)) * regr_syy(l_extendedprice, l_quantity) AS rss FROM lineitem) "
        "SELECT '(Intercept)' AS name, round(a, 4) AS estimate, round(sqrt(rss / (n - 2) * (1 / n + m * m / sxx)), 4) "
        "AS std_error FROM f UNION ALL SELECT 'l_quantity', round(b, 4), round(sqrt(rss / (n - 2) / sxx), 4) FROM f",
    ),
    "ols_mixed": (
        ols_mixed,
        # within-flag slope, then flag means of what it leaves over
        f"WITH {LINE_STUDY}, m AS (SELECT l_returnflag, avg(l_quantity) AS mq, avg(y) AS my FROM study GROUP BY 1), "
        "s AS (SELECT sum((l_quantity - mq) * (y - my)) / sum((l_quantity - mq) ** 2) AS b FROM study JOIN m USING (l_returnflag)), "
        "e AS (SELECT l_returnflag, my - b * mq AS a, b FROM m, s) "
        "SELECT '(Intercept)' AS name, round(a, 6) AS estimate FROM e WHERE l_returnflag = 'A' UNION ALL "
        "SELECT 'l_quantity', round(b, 6) FROM s UNION ALL "
        "SELECT 'l_returnflag' || l_returnflag, round(a - (SELECT a FROM e WHERE l_returnflag = 'A'), 6) FROM e WHERE l_returnflag <> 'A'",
    ),
    "gvif_two": (
        gvif_two,
        _CORRS + "g AS (SELECT 1 / (1 - ab * ab) AS v FROM r) SELECT t AS term, round(v, 6) AS gvif, 1 AS df, "
        "round(sqrt(v), 6) AS gvif_scaled FROM g, (VALUES ('l_quantity'), ('y')) x(t)",
    ),
    "gvif_factor": (
        gvif_factor,
        _CORRS + f"g AS (SELECT 'l_quantity' AS term, {_det3('bc', 'be', 'ce')} / {_DET4} AS v, 1 AS df FROM r UNION ALL "
        f"SELECT 'y', {_det3('ac', 'ae', 'ce')} / {_DET4}, 1 FROM r UNION ALL "
        f"SELECT 'l_returnflag', (1 - ce * ce) * (1 - ab * ab) / {_DET4}, 2 FROM r) "
        "SELECT term, round(v, 6) AS gvif, df, round(v ** (1 / (2.0 * df)), 6) AS gvif_scaled FROM g",
    ),
}
