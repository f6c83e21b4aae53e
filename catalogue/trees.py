"""Boosted trees, sweeps and explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.fit_sql import ada_trees, newton_trees
from catalogue.inputs import LINE_KEY, LINE_STUDY, line_study, rounded, unit_sql
from riskframe.operators import boost as B
from riskframe.operators import explain as E
from riskframe.operators.metrics import confusion
from riskframe.operators.split import in_test

X = ["l_quantity", "l_discount", "l_tax"]
NEWTON_GRID = B.product(min_child_weight=[1, 8], eta=[0.1, 0.3])
ADA_GRID = B.product(max_leaf_nodes=[3, 4], learning_rate=[0.4, 1.0])
# the grids of the original study
NEWTON_RATES = B.product(eta=B.grid(0.01, 1, 0.05))
NEWTON_WEIGHTS = B.product(min_child_weight=list(range(9)), eta=B.grid(0.01, 0.5, 0.05))
ADA_RATES = B.product(learning_rate=B.grid(0.1, 2.4, 0.3))
ADA_LEAVES = B.product(max_leaf_nodes=[int(v) for v in B.grid(10, 50, 10)], learning_rate=B.grid(0.1, 1.3, 0.3))
PRICED = ["l_extendedprice", "l_discount"]


def _margins(df, model):
    """Margin of every row, reported per feature pattern."""
    scored = model.predict(df, margin="margin")
    return rounded(scored.groupBy(*X).agg(F.max("margin").alias("margin"), F.count("*").alias("n")), 5)


def newton_first_stump(spark, sf):
    model = B.newton_boost(line_study(spark, sf), "y", X, rounds=1, max_depth=1)
    return rounded(model.to_df(spark), 5)


def newton_margins(spark, sf):
    lines = line_study(spark, sf)
    return _margins(lines, B.newton_boost(lines, "y", X, rounds=3, max_depth=2))


def newton_penalised_margins(spark, sf):
    lines = line_study(spark, sf)
    model = B.newton_boost(lines, "y", X, eta=0.06, rounds=2, max_depth=3, reg_lambda=5.0, min_child_weight=60)
    return _margins(lines, model)


def newton_confusion(spark, sf):
    lines = line_study(spark, sf)
    return confusion(B.newton_boost(lines, "y", X, rounds=3, max_depth=2).predict(lines))


def newton_continuous(spark, sf):
    """Training on a feature with more values than bins, past the rewriting of the margins."""
    lines = line_study(spark, sf)
    model = B.newton_boost(lines, "y", [*X, "l_extendedprice"], rounds=10, max_depth=4)
    return model.predict(lines).groupBy("y", "pred").agg(F.count("*").alias("n"))


def _by_margin(df, model):
    scored = model.predict(df, margin="margin").withColumn("margin", F.round("margin", 5))
    return scored.groupBy("margin").agg(F.count("*").alias("n"))


def adaboost_continuous_stumps(spark, sf):
    """Exact splits among all values of a price."""
    lines = line_study(spark, sf)
    return _by_margin(lines, B.adaboost(lines, "y", PRICED, rounds=5))


def adaboost_continuous_leaves(spark, sf):
    lines = line_study(spark, sf)
    return _by_margin(lines, B.adaboost(lines, "y", PRICED, rounds=2, learning_rate=0.8, max_leaf_nodes=6))


def tree_continuous(spark, sf):
    lines = line_study(spark, sf)
    return _by_margin(lines, B.hist_tree(lines, "y", PRICED, max_leaf_nodes=9))


def adaboost_rounds(spark, sf):
    return rounded(B.adaboost(line_study(spark, sf), "y", X, rounds=3, variant="samme").rounds_df(spark), 5)


def adaboost_samme_margins(spark, sf):
    lines = line_study(spark, sf)
    return _margins(lines, B.adaboost(lines, "y", X, rounds=3, variant="samme"))


def adaboost_probability_margins(spark, sf):
    lines = line_study(spark, sf)
    return _margins(lines, B.adaboost(lines, "y", X, rounds=3, learning_rate=0.7))


def adaboost_leaf_cap_margins(spark, sf):
    lines = line_study(spark, sf)
    return _margins(lines, B.adaboost(lines, "y", X, rounds=2, learning_rate=0.8, max_leaf_nodes=4))


def adaboost_importance(spark, sf):
    model = B.adaboost(line_study(spark, sf), "y", X, rounds=3, learning_rate=0.7)
    return rounded(B.tree_importance(model, spark))


def tree_leaf_cap(spark, sf):
    lines = line_study(spark, sf)
    model = B.hist_tree(lines, "y", X, max_leaf_nodes=6)
    scored = model.predict(lines)
    return rounded(scored.groupBy(*X).agg(F.max("prob").alias("prob"), F.max("pred").alias("pred")), 5)


def _sides(spark, sf):
    lines = line_study(spark, sf)
    test = in_test(LINE_KEY, 0.3, 25)
    return lines.filter(~test), lines.filter(test)


def newton_sweep(spark, sf):
    return rounded(B.sweep("newton", NEWTON_GRID, *_sides(spark, sf), "y", X, rounds=2, max_depth=2))


def adaboost_sweep(spark, sf):
    return rounded(B.sweep("samme.r", ADA_GRID, *_sides(spark, sf), "y", X, rounds=2))


def sweep_best_by_weight(spark, sf):
    result = B.sweep("newton", NEWTON_GRID, *_sides(spark, sf), "y", X, rounds=2, max_depth=2)
    return rounded(B.best_of(result, "test_acc", ["eta"], by=["min_child_weight"]))


def newton_sweep_rates(spark, sf):
    """All 20 learning rates of the original, 100 rounds each."""
    return rounded(B.sweep("newton", NEWTON_RATES, *_sides(spark, sf), "y", X))


def newton_sweep_weights(spark, sf):
    """All 90 points of child weight and learning rate, 100 rounds each."""
    return rounded(B.sweep("newton", NEWTON_WEIGHTS, *_sides(spark, sf), "y", X))


def adaboost_sweep_rates(spark, sf):
    """All 8 learning rates, 50 rounds each."""
    return rounded(B.sweep("samme.r", ADA_RATES, *_sides(spark, sf), "y", X))


def adaboost_sweep_leaves(spark, sf):
    """All 16 points of leaf cap and learning rate, 200 rounds each."""
    return rounded(B.sweep("samme.r", ADA_LEAVES, *_sides(spark, sf), "y", X, rounds=200))


def _stumps(spark, sf):
    lines = line_study(spark, sf)
    return lines, B.newton_boost(lines, "y", X, rounds=3, max_depth=1)


def shap_stumps(spark, sf):
    lines, model = _stumps(spark, sf)
    shap = E.tree_shap(lines, model, X)
    return rounded(shap.groupBy(*X, "feature").agg(F.max("shap").alias("shap"), F.count("*").alias("n")), 5)


def shap_mean_absolute(spark, sf):
    lines, model = _stumps(spark, sf)
    return rounded(E.shap_summary(E.tree_shap(lines, model, LINE_KEY)), 5)


def shap_base(spark, sf):
    return rounded(E.base_value(_stumps(spark, sf)[1], spark), 5)


def shap_additive(spark, sf):
    """Rows whose values and base add up to the margin, for deep trees: all of them must."""
    lines = line_study(spark, sf)
    model = B.newton_boost(lines, "y", X, rounds=3, max_depth=4)
    scored = model.predict(lines, margin="margin").select(*X, "margin").distinct()
    sums = E.tree_shap(scored, model, X).groupBy(*X).agg(F.sum("shap").alias("total"))
    gap = F.abs(F.col("total") + E.expected_margin(model) - F.col("margin"))
    return scored.join(sums, X).agg(F.count("*").alias("n"), F.count_if(gap < 1e-9).alias("n_additive"))


def shap_with_values(spark, sf):
    lines, model = _stumps(spark, sf)
    cells = lines.select(*X).distinct().withColumn("cell", F.concat_ws("|", *[F.round(F.col(c) * 100).cast("int") for c in X]))
    return rounded(E.shap_values(cells, model, ["cell"]), 5)


# ---- SQL -------------------------------------------------------------------------------

_CELLS = f"cells AS MATERIALIZED (SELECT {', '.join(X)}, y, count(*)::DOUBLE AS n FROM study GROUP BY ALL)"
_SPLIT_CELLS = (
    f"cells AS MATERIALIZED (SELECT {', '.join(X)}, y, count(*) FILTER (NOT test)::DOUBLE AS n, count(*) FILTER (test)::DOUBLE AS n_test "
    "FROM (SELECT *, " + unit_sql(LINE_KEY, 25) + " < 0.3 AS test FROM study) GROUP BY ALL)"
)


def _with(*parts: str) -> str:
    return f"WITH {LINE_STUDY}, " + ", ".join(parts) + " "


def _margin_sql(trees) -> str:
    cols = ", ".join(f"round({c}, 5) AS {c}" for c in X)
    return _with(_CELLS, *trees.ctes) + (
        f"SELECT {cols}, round(max(m), 5) AS margin, sum(n)::BIGINT AS n FROM {trees.rows} GROUP BY ALL"
    )


_PARTS = (
    f"parts AS (SELECT {', '.join(X)}, y, min(l_extendedprice) OVER (PARTITION BY part) AS part_price FROM ("
    "SELECT *, (rank() OVER (ORDER BY l_extendedprice) - 1) * 256 // count(*) OVER () AS part FROM study)), "
    f"cells AS MATERIALIZED (SELECT {', '.join(X)}, part_price, y, count(*)::DOUBLE AS n FROM parts GROUP BY ALL)"
)
_CONTINUOUS = newton_trees("nc", "cells", [*X, "part_price"], 10, 4)
_PRICE_CELLS = f"cells AS MATERIALIZED (SELECT {', '.join(PRICED)}, y, count(*)::DOUBLE AS n FROM study GROUP BY ALL)"


def _by_margin_sql(trees) -> str:
    return _with(_PRICE_CELLS, *trees.ctes) + f"SELECT round(m, 5) AS margin, sum(n)::BIGINT AS n FROM {trees.rows} GROUP BY 1"


_FEATURE = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(X)) + " END"
_STUMP = newton_trees("nb", "cells", X, 1, 1)
_STUMP_ROW = _STUMP.round_ctes[0]
_STUMPS = newton_trees("nb", "cells", X, 3, 1)
_ADA_R = ada_trees("ab", "cells", X, 3, 0.7)
_ADA_S = ada_trees("ab", "cells", X, 3, 1.0, variant="samme")


def _first_stump_sql() -> str:
    root = (
        f"SELECT 1 AS tree, 0 AS node, {_FEATURE} AS feature, nt AS threshold, 1 AS \"left\", 2 AS \"right\", NULL::DOUBLE AS leaf_value, "
        f"tb AS cover, gain FROM {_STUMP_ROW['splits'][0]}"
    )
    leaf = f"SELECT 1, node, NULL, NULL, NULL, NULL, leaf, gb, 0.0 FROM {_STUMP_ROW['leaves']}"
    return _with(_CELLS, *_STUMP.ctes) + (
        "SELECT tree, node, feature, round(threshold, 5) AS threshold, \"left\", \"right\", round(leaf_value, 5) AS leaf_value, "
        f"round(cover, 5) AS cover, round(gain, 5) AS gain FROM ({root} UNION ALL {leaf}) t(tree, node, feature, threshold, \"left\", \"right\", leaf_value, cover, gain)"
    )


def _stump_table() -> str:
    """CTE of the stumps: feature, cut value, both leaf values and their mean by cover."""
    parts = []
    for r in _STUMPS.round_ctes:
        parts.append(
            f"SELECT f, t, (SELECT leaf FROM {r['leaves']} WHERE node = 1) AS vl, (SELECT leaf FROM {r['leaves']} WHERE node = 2) AS vr, "
            f"(SELECT sum(leaf * gb) / sum(gb) FROM {r['leaves']}) AS mean FROM {r['splits'][0]}"
        )
    return "stumps AS (" + " UNION ALL ".join(parts) + ")"


def _phi(i: int, c: str) -> str:
    return f"coalesce((SELECT sum(CASE WHEN {c} <= t THEN vl ELSE vr END - mean) FROM stumps WHERE f = {i}), 0)"


_PHI_LONG = " UNION ALL ".join(
    f"SELECT {', '.join(X)}, '{c}' AS feature, {c} AS value, {_phi(i, c)} AS shap, n FROM k" for i, c in enumerate(X)
)
_SHAP = _with(
    _CELLS, *_STUMPS.ctes, _stump_table(), f"k AS (SELECT {', '.join(X)}, sum(n) AS n FROM cells GROUP BY ALL)",
    f"phi AS MATERIALIZED ({_PHI_LONG})",
)


def _sweep_sql(kind: str) -> tuple[str, str]:
    """CTEs and the select of all grid points with both accuracies."""
    ctes, rows = [], []
    for i, p in enumerate(NEWTON_GRID if kind == "newton" else ADA_GRID):
        if kind == "newton":
            trees = newton_trees(f"p{i}", "cells", X, 2, 2, eta=p["eta"], mcw=p["min_child_weight"])
        else:
            trees = ada_trees(f"p{i}", "cells", X, 2, p["learning_rate"], p["max_leaf_nodes"])
        ctes += trees.ctes
        params = ", ".join(f"{v}::DOUBLE AS {k}" for k, v in p.items())
        right = "sum({n}) FILTER ((m > 0) = (y = 1)) / sum({n})"
        rows.append(
            f"SELECT {params}, {right.format(n='n')} AS train_acc, {right.format(n='n_test')} AS test_acc FROM {trees.rows}"
        )
    return _with(_SPLIT_CELLS, *ctes), " UNION ALL ".join(rows)


def _sweep_report(kind: str, names: list[str]) -> str:
    head, rows = _sweep_sql(kind)
    return head + f"SELECT {', '.join(names)}, round(train_acc, 6) AS train_acc, round(test_acc, 6) AS test_acc FROM ({rows})"


def _best_sql() -> str:
    head, rows = _sweep_sql("newton")
    return head + (
        f"SELECT min_child_weight, eta, round(test_acc, 6) AS test_acc FROM ({rows}) "
        "QUALIFY row_number() OVER (PARTITION BY min_child_weight ORDER BY test_acc DESC, eta) = 1"
    )


_TREE = ada_trees("dt", "cells", X, 1, leaves=6)
_NEWTON32 = newton_trees("nb", "cells", X, 3, 2)

QUERIES = {
    "newton_first_stump": (newton_first_stump, _first_stump_sql()),
    "newton_margins": (newton_margins, _margin_sql(_NEWTON32)),
    "newton_penalised_margins": (
        newton_penalised_margins, _margin_sql(newton_trees("nb", "cells", X, 2, 3, eta=0.06, lam=5.0, mcw=60))
    ),
    "newton_confusion": (
        newton_confusion,
        _with(_CELLS, *_NEWTON32.ctes)
        + f"SELECT actual, predicted, (SELECT coalesce(sum(n), 0)::BIGINT FROM {_NEWTON32.rows} WHERE y = actual AND (m > 0) = (predicted = 1)) AS n "
        "FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(actual, predicted)",
    ),
    "newton_continuous": (
        newton_continuous,
        _with(_PARTS, *_CONTINUOUS.ctes)
        + f"SELECT y, CAST(m > 0 AS INTEGER) AS pred, sum(n)::BIGINT AS n FROM {_CONTINUOUS.rows} GROUP BY ALL",
    ),
    "adaboost_continuous_stumps": (adaboost_continuous_stumps, _by_margin_sql(ada_trees("cs", "cells", PRICED, 5))),
    "adaboost_continuous_leaves": (adaboost_continuous_leaves, _by_margin_sql(ada_trees("cl", "cells", PRICED, 2, 0.8, leaves=6))),
    "tree_continuous": (tree_continuous, _by_margin_sql(ada_trees("ct", "cells", PRICED, 1, leaves=9))),
    "adaboost_rounds": (
        adaboost_rounds,
        _with(_CELLS, *_ADA_S.ctes)
        + " UNION ALL ".join(
            f"SELECT {i} AS round, round(err, 5) AS error, round(ln((1 - err) / err), 5) AS weight FROM {r['stats']}"
            for i, r in enumerate(_ADA_S.round_ctes, start=1)
        ),
    ),
    "adaboost_samme_margins": (adaboost_samme_margins, _margin_sql(_ADA_S)),
    "adaboost_probability_margins": (adaboost_probability_margins, _margin_sql(_ADA_R)),
    "adaboost_leaf_cap_margins": (adaboost_leaf_cap_margins, _margin_sql(ada_trees("ab", "cells", X, 2, 0.8, leaves=4))),
    "adaboost_importance": (
        adaboost_importance,
        # a stump has one split, so its whole importance falls to that feature
        _with(_CELLS, *_ADA_R.ctes)
        + "SELECT feature, round(count(f) / 3, 6) AS importance FROM (VALUES "
        + ", ".join(f"({i}, '{c}')" for i, c in enumerate(X))
        + ") x(i, feature) LEFT JOIN ("
        + " UNION ALL ".join(f"SELECT f FROM {r['splits'][0]}" for r in _ADA_R.round_ctes)
        + ") ON f = i GROUP BY feature",
    ),
    "tree_leaf_cap": (
        tree_leaf_cap,
        _with(_CELLS, *_TREE.ctes)
        + f"SELECT {', '.join(f'round({c}, 5) AS {c}' for c in X)}, round(max(1 / (1 + exp(-2 * m))), 5) AS prob, "
        f"max(CAST(m > 0 AS INTEGER)) AS pred FROM {_TREE.rows} GROUP BY ALL",
    ),
    "newton_sweep": (newton_sweep, _sweep_report("newton", ["min_child_weight", "eta"])),
    "adaboost_sweep": (adaboost_sweep, _sweep_report("samme.r", ["max_leaf_nodes", "learning_rate"])),
    "sweep_best_by_weight": (sweep_best_by_weight, _best_sql()),
    # up to 90 models of 100 rounds are beyond SQL; tests hold the same fits against plain numpy
    "newton_sweep_rates": (newton_sweep_rates, None),
    "newton_sweep_weights": (newton_sweep_weights, None),
    "adaboost_sweep_rates": (adaboost_sweep_rates, None),
    "adaboost_sweep_leaves": (adaboost_sweep_leaves, None),
    "shap_stumps": (
        shap_stumps,
        _SHAP + f"SELECT {', '.join(f'round({c}, 5) AS {c}' for c in X)}, feature, round(shap, 5) AS shap, n::BIGINT AS n FROM phi",
    ),
    "shap_mean_absolute": (
        shap_mean_absolute,
        _SHAP + "SELECT feature, round(sum(abs(shap) * n) / sum(n), 5) AS mean_abs_shap FROM phi GROUP BY 1",
    ),
    "shap_base": (
        shap_base,
        _SHAP + "SELECT round((SELECT 4 * (sum(y * n) / sum(n) - 0.5) FROM cells) + (SELECT sum(mean) FROM stumps), 5) AS base_value",
    ),
    "shap_additive": (
        shap_additive,
        f"SELECT count(*) AS n, count(*) AS n_additive FROM (SELECT DISTINCT {', '.join(X)} FROM lineitem)",
    ),
    "shap_with_values": (
        shap_with_values,
        _SHAP + "SELECT concat_ws('|', " + ", ".join(f"round({c} * 100)::INTEGER" for c in X)
        + ") AS cell, feature, round(value, 5) AS value, round(shap, 5) AS shap FROM phi",
    ),
}
