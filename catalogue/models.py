"""Logistic models, stepwise selection and k-means."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from catalogue.fit_sql import lloyd, logit
from catalogue.inputs import LINE_STUDY, line_study, rounded, table
from riskframe.functions.columns import quoted
from riskframe.operators import cluster as K
from riskframe.operators import linear as L
from riskframe.operators.design import dummy_columns, factors
from riskframe.operators.group_models import group_logit_table
from riskframe.operators.metrics import classification_report, rmse
from riskframe.operators.stepwise import stepwise_logit

TOL = 1e-13  # tighter than the default stop, so that all digits compared are final
SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
RIDGE_X = ["l_quantity", "l_tax"]
STEP_TERMS = ["l_quantity", "l_returnflag", "l_linestatus"]


# ---- GLM -------------------------------------------------------------------------------


def _glm_factor(spark, sf):
    lines = line_study(spark, sf)
    return L.glm_logit(lines, "y", ["l_quantity", "l_returnflag"], factors(lines, ["l_returnflag"]), tol=TOL)


def glm_binary_predictor(spark, sf):
    labels = table(spark, sf, "labels")
    return rounded(L.glm_logit(labels, "toxic", ["quality"], tol=TOL).to_df(spark).drop("p_value"))


def glm_binary_predictor_stats(spark, sf):
    stats = L.glm_logit(table(spark, sf, "labels"), "toxic", ["quality"], tol=TOL).stats_df(spark)
    return rounded(stats.filter(~F.col("stat").isin("iterations", "converged")))


def glm_coefficients(spark, sf):
    return rounded(_glm_factor(spark, sf).to_df(spark).drop("p_value"), 5)


def glm_statistics(spark, sf):
    stats = _glm_factor(spark, sf).stats_df(spark)
    return rounded(stats.filter(F.col("stat") != "iterations"), 4)


def glm_significant(spark, sf):
    coefs = L.significant_terms(_glm_factor(spark, sf).to_df(spark))
    return rounded(coefs.select("name", "estimate"), 5)


def glm_significant_columns(spark, sf):
    """Dummy table reduced to the significant columns and the target, summed by target."""
    lines = line_study(spark, sf)
    levels = factors(lines, ["l_returnflag"])
    names = [name for name, _, _, _, p in _glm_factor(spark, sf).rows() if p is not None and p <= 0.1 and name != L.INTERCEPT]
    chosen = L.select_significant(dummy_columns(lines, levels), names, "y")
    long = chosen.withColumns({c: quoted(c).cast("double") for c in names}).unpivot(["y"], names, "name", "value")
    return rounded(long.groupBy("name", "y").agg(F.sum("value").alias("total"), F.count("*").alias("n")))


# ---- ridge -----------------------------------------------------------------------------


def _ridge(spark, sf):
    return L.ridge_logit(line_study(spark, sf), "y", RIDGE_X)


def ridge_importance(spark, sf):
    return rounded(_ridge(spark, sf).importance(spark))


def ridge_scores(spark, sf):
    scored = _ridge(spark, sf).score(line_study(spark, sf))
    return rounded(scored.groupBy(*RIDGE_X).agg(F.max("prob").alias("prob"), F.count("*").alias("n")))


def stepwise_path(spark, sf):
    lines = line_study(spark, sf)
    fit = stepwise_logit(lines, "y", STEP_TERMS, factors(lines, ["l_returnflag", "l_linestatus"]))
    return rounded(fit.path_df(spark), 4)


# ---- models per group ------------------------------------------------------------------


def grouped(spark, sf):
    """Return flags as groups, with the large quantities, all of one class, as a fourth one."""
    return line_study(spark, sf).withColumn("grp", F.when(F.col("l_quantity") >= 40, "big").otherwise(F.col("l_returnflag")))


def group_coefficients(spark, sf):
    fits = L.per_group_logit(grouped(spark, sf), "grp", "y", RIDGE_X)
    return rounded(fits.to_df(spark), 5)


def group_importance_matrix(spark, sf):
    coefs = L.per_group_logit(grouped(spark, sf), "grp", "y", RIDGE_X).to_df(spark)
    return rounded(L.importance_matrix(coefs, "grp", ["A", "N", "R", "big"]), 5)


def group_report(spark, sf):
    frame = grouped(spark, sf)
    scored = L.per_group_logit(frame, "grp", "y", RIDGE_X).score(frame, threshold=0.58)
    return rounded(classification_report(scored.dropna(subset=["pred"]), by=["grp"]))


def group_report_all(spark, sf):
    """As ``group_report``, with the group of one class, which has no model: predicted label "null"."""
    frame = grouped(spark, sf)
    scored = L.per_group_logit(frame, "grp", "y", RIDGE_X).score(frame, threshold=0.58)
    return rounded(classification_report(scored, by=["grp"], nulls="label"))


def group_models_by_part(spark, sf):
    """A model for every part, from a table of fits: as many groups as the table has parts."""
    fits = group_logit_table(line_study(spark, sf).withColumnRenamed("l_partkey", "grp"), "grp", "y", RIDGE_X)
    return rounded(fits.to_df(), 5)


def group_scores_by_part(spark, sf):
    """Every row scored by the model of its part, summed by return flag."""
    lines = line_study(spark, sf).withColumnRenamed("l_partkey", "grp")
    scored = group_logit_table(lines, "grp", "y", RIDGE_X).score(lines)
    return rounded(scored.groupBy("l_returnflag").agg(F.sum("prob").alias("expected"), F.count("prob").alias("n")), 4)


def group_rmse(spark, sf):
    frame = grouped(spark, sf)
    scored = L.per_group_logit(frame, "grp", "y", RIDGE_X).score(frame, threshold=0.58)
    return rounded(rmse(scored, by=["grp"]))


# ---- k-means ---------------------------------------------------------------------------


def _line_vectors(spark, sf):
    return K.scaled_vector(table(spark, sf, "lineitem"), SCALED)


def kmeans_centers(spark, sf):
    return rounded(K.kmeans(_line_vectors(spark, sf), "features", 6).centers_df(spark), 5)


def kmeans_sizes(spark, sf):
    vectors = _line_vectors(spark, sf)
    labelled = K.kmeans(vectors, "features", 6).predict(vectors)
    return labelled.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"))


def kmeans_elbow(spark, sf):
    return rounded(K.elbow(_line_vectors(spark, sf), "features", [1, 2, 3, 4]), 4)


def kmeans_elbow_20(spark, sf):
    """All 20 numbers of clusters of the original."""
    return rounded(K.elbow(_line_vectors(spark, sf), "features"), 4)


def _embeddings(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return vectors.withColumn("features", F.col("embedding").cast("array<double>"))


def kmeans_embeddings(spark, sf):
    vectors = _embeddings(spark, sf)
    return K.kmeans(vectors, "features", 10).predict(vectors).select("vec_id", "cluster")


def elbow_embeddings(spark, sf):
    return rounded(K.elbow(_embeddings(spark, sf), "features", [1, 2, 5, 10]), 5)


def elbow_embeddings_20(spark, sf):
    return rounded(K.elbow(_embeddings(spark, sf), "features"), 5)


def kmeans_oversampled(spark, sf):
    """Clusters from oversampled starts; the draw is beyond SQL, so their number and rows are compared."""
    vectors = _line_vectors(spark, sf)
    labelled = K.kmeans(vectors, "features", 6, start="oversampled").predict(vectors)
    return labelled.agg(F.countDistinct("cluster").alias("clusters"), F.count("cluster").alias("n"))


# ---- SQL -------------------------------------------------------------------------------


def _with(*ctes) -> str:
    return "WITH " + ", ".join(c for part in ctes for c in ([part] if isinstance(part, str) else part)) + " "


def _cells(name: str, columns: dict[str, str], group: str = "") -> str:
    cols = ", ".join(f"{v} AS {k}" for k, v in columns.items())
    g = f"{group} AS grp, " if group else ""
    return (
        f"{name} AS (SELECT *, 1 AS one FROM (SELECT {g}{cols}, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s FROM study GROUP BY ALL))"
    )


def _flag(v: str) -> str:
    return f"CAST(l_returnflag = '{v}' AS DOUBLE)"


_FACTOR = _with(LINE_STUDY, _cells("cells", {"x1": "l_quantity", "x2": _flag("N"), "x3": _flag("R")}), logit("fit", "cells", 4))
_FACTOR_NAMES = ["(Intercept)", "l_quantity", "l_returnflagN", "l_returnflagR"]
_FACTOR_LONG = " UNION ALL ".join(f"SELECT '{n}' AS name, b{i} AS b, sqrt(v{i}) AS se FROM fit" for i, n in enumerate(_FACTOR_NAMES))

_LABEL_CELLS = (
    "t AS (SELECT count(*) FILTER (quality = 1 AND toxic = 1)::DOUBLE AS a, count(*) FILTER (quality = 1 AND toxic = 0)::DOUBLE AS b, "
    "count(*) FILTER (quality = 0 AND toxic = 1)::DOUBLE AS c, count(*) FILTER (quality = 0 AND toxic = 0)::DOUBLE AS d FROM labels)"
)
_LABEL_DEV = (
    "g AS (SELECT *, a + b + c + d AS n, -2 * (a * ln(a / (a + b)) + b * ln(b / (a + b)) + c * ln(c / (c + d)) + d * ln(d / (c + d))) AS dev, "
    "-2 * ((a + c) * ln((a + c) / (a + b + c + d)) + (b + d) * ln((b + d) / (a + b + c + d))) AS nul FROM t)"
)

_RIDGE = _with(LINE_STUDY, _cells("cells", {"x1": "l_quantity", "x2": "l_tax"}), logit("fit", "cells", 3, ridge=1.0))


def _stepwise_sql() -> str:
    parts = {1: ["l_quantity"], 2: [_flag("N"), _flag("R")], 4: ["CAST(l_linestatus = 'O' AS DOUBLE)"]}
    ctes, models = [LINE_STUDY], []
    for size in range(4):
        for bits in combinations(parts, size):
            mask = sum(bits)
            x = [c for b in bits for c in parts[b]]
            ctes.append(_cells(f"cells{mask}", {f"x{i}": c for i, c in enumerate(x, start=1)} or {"x0": "1.0"}))
            ctes += logit(f"fit{mask}", f"cells{mask}", len(x) + 1)
            models.append(f"SELECT {mask} AS mask, {len(x) + 1} AS n_coef, dev AS deviance, dev + {2 * (len(x) + 1)} AS aic FROM fit{mask}")
    ctes.append("models AS MATERIALIZED (" + " UNION ALL ".join(models) + ")")
    ctes.append("step0 AS (SELECT 0 AS step, 'start' AS action, '' AS term, * FROM models WHERE mask = 7)")
    terms = "CASE xor(m.mask, p.mask) WHEN 1 THEN 'l_quantity' WHEN 2 THEN 'l_returnflag' ELSE 'l_linestatus' END"
    for k in range(1, 5):
        ctes.append(
            f"step{k} AS (SELECT {k} AS step, CASE WHEN m.mask < p.mask THEN 'drop' ELSE 'add' END AS action, {terms} AS term, m.* "
            f"FROM step{k - 1} p JOIN models m ON bit_count(xor(m.mask, p.mask)) = 1 AND m.aic < p.aic "
            "QUALIFY row_number() OVER (ORDER BY m.aic) = 1)"
        )
    path = " UNION ALL ".join(f"SELECT * FROM step{k}" for k in range(5))
    return _with(ctes) + f"SELECT step, action, term, n_coef, round(deviance, 4) AS deviance, round(aic, 4) AS aic FROM ({path})"


_GRP = "CASE WHEN l_quantity >= 40 THEN 'big' ELSE l_returnflag END"
_GROUPS = _with(
    LINE_STUDY,
    _cells("cells_all", {"x1": "l_quantity", "x2": "l_tax"}, _GRP),
    "cells AS (SELECT * FROM cells_all WHERE grp <> 'big')",
    logit("fit", "cells", 3, ridge=1.0, group="grp"),
)
_PARTS = _with(
    LINE_STUDY,
    _cells("cells_all", {"x1": "l_quantity", "x2": "l_tax"}, "l_partkey"),
    "cells AS (SELECT * FROM cells_all WHERE grp IN (SELECT grp FROM cells_all GROUP BY 1 HAVING sum(s) > 0 AND sum(s) < sum(n)))",
    logit("fit", "cells", 3, ridge=1.0, group="grp"),
)
_GROUP_LONG = (
    "SELECT grp, 'l_quantity' AS feature, b1 AS v FROM fit UNION ALL SELECT grp, 'l_tax', b2 FROM fit "
    "UNION ALL SELECT 'big', 'l_quantity', NULL UNION ALL SELECT 'big', 'l_tax', NULL"
)
_GROUP_SCORED = (
    f"z AS (SELECT * FROM (SELECT *, {_GRP} AS grp FROM study) JOIN fit USING (grp)), "
    "p AS (SELECT grp, y, CAST(1 / (1 + exp(-(b0 + b1 * l_quantity + b2 * l_tax))) > 0.58 AS INTEGER) AS pred FROM z)"
)


def _group_report_sql() -> str:
    return (
        _GROUPS + ", " + _GROUP_SCORED + ", c AS (SELECT grp, label, count(*) FILTER (y = label AND pred = label) AS hit, "
        "count(*) FILTER (pred = label) AS claimed, count(*) FILTER (y = label) AS support FROM p, (VALUES (0), (1)) l(label) GROUP BY ALL), "
        "m AS (SELECT *, coalesce(hit / nullif(claimed, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r FROM c), "
        "f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM m), "
        "t AS (SELECT grp, sum(support)::BIGINT AS total, sum(hit) / sum(support) AS acc, avg(p) AS mp, avg(r) AS mr, avg(f1) AS mf, "
        "sum(p * support) / sum(support) AS wp, sum(r * support) / sum(support) AS wr, sum(f1 * support) / sum(support) AS wf "
        "FROM f GROUP BY 1), o AS (SELECT grp, label::VARCHAR AS label, p, r, f1, support FROM f UNION ALL "
        "SELECT grp, 'accuracy', acc, acc, acc, total FROM t UNION ALL SELECT grp, 'macro avg', mp, mr, mf, total FROM t "
        "UNION ALL SELECT grp, 'weighted avg', wp, wr, wf, total FROM t) "
        "SELECT grp, label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM o"
    )


def _group_report_all_sql() -> str:
    measures = "0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE"
    lone = f"(SELECT y, count(*) AS n FROM study WHERE {_GRP} = 'big' GROUP BY 1)"
    return (
        _group_report_sql() + f" UNION ALL SELECT 'big', y::VARCHAR, {measures}, n FROM {lone} "
        f"UNION ALL SELECT 'big', l, {measures}, n FROM {lone}, (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) v(l) "
        f"UNION ALL SELECT 'big', 'null', {measures}, 0"
    )


_SCALED_POINTS = (
    "r AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in SCALED) + " FROM lineitem), "
    "pts AS MATERIALIZED (SELECT row_number() OVER () AS id, l_linenumber, ["
    + ", ".join(f"({c} - lo_{c}) / (hi_{c} - lo_{c})" for c in SCALED) + "] AS v FROM lineitem, r)"
)
_FOLDED_POINTS = "folded AS MATERIALIZED (SELECT row_number() OVER () AS id, v, count(*)::DOUBLE AS n FROM pts GROUP BY v)"
_EMB_POINTS = "pts AS MATERIALIZED (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings)"

QUERIES = {
    "glm_binary_predictor": (
        glm_binary_predictor,
        _with(_LABEL_CELLS)
        + "SELECT name, round(b, 6) AS estimate, round(se, 6) AS std_error, round(b / se, 6) AS z_value FROM ("
        "SELECT '(Intercept)' AS name, ln(c / d) AS b, sqrt(1 / c + 1 / d) AS se FROM t UNION ALL "
        "SELECT 'quality', ln(a * d / (b * c)), sqrt(1 / a + 1 / b + 1 / c + 1 / d) FROM t)",
    ),
    "glm_binary_predictor_stats": (
        glm_binary_predictor_stats,
        _with(_LABEL_CELLS, _LABEL_DEV)
        + "SELECT stat, round(value, 6) AS value FROM (SELECT unnest(['null_deviance', 'df_null', 'deviance', 'df_residual', 'aic']) AS stat, "
        "unnest([nul, n - 1, dev, n - 2, dev + 4]) AS value FROM g)",
    ),
    "glm_coefficients": (
        glm_coefficients,
        _FACTOR + "SELECT name, round(b, 5) AS estimate, round(se, 5) AS std_error, round(b / se, 5) AS z_value FROM " + f"({_FACTOR_LONG})",
    ),
    "glm_statistics": (
        glm_statistics,
        _FACTOR + ", t AS (SELECT sum(n) AS n, sum(s) / sum(n) AS r FROM cells) SELECT stat, round(value, 4) AS value FROM (SELECT "
        "unnest(['null_deviance', 'df_null', 'deviance', 'df_residual', 'aic', 'converged']) AS stat, "
        "unnest([-2 * n * (r * ln(r) + (1 - r) * ln(1 - r)), n - 1, dev, n - 4, dev + 8, 1]) AS value FROM fit, t)",
    ),
    "glm_significant": (
        glm_significant,
        # p <= 0.1 is |z| >= the upper 5% point of the normal law
        _FACTOR + f"SELECT name, round(b, 5) AS estimate FROM ({_FACTOR_LONG}) WHERE abs(b / se) >= 1.6448536269514722 AND name <> '(Intercept)'",
    ),
    "glm_significant_columns": (
        glm_significant_columns,
        _FACTOR + "SELECT name, y, round(sum(value), 6) AS total, count(*) AS n FROM (SELECT y, "
        "unnest(['l_quantity', 'l_returnflagN', 'l_returnflagR']) AS name, "
        f"unnest([l_quantity, {_flag('N')}, {_flag('R')}]) AS value FROM study) JOIN ({_FACTOR_LONG}) USING (name) "
        "WHERE abs(b / se) >= 1.6448536269514722 GROUP BY 1, 2",
    ),
    "ridge_importance": (
        ridge_importance,
        _RIDGE + "SELECT 'l_quantity' AS feature, round(b1, 6) AS importance FROM fit UNION ALL SELECT 'l_tax', round(b2, 6) FROM fit",
    ),
    "ridge_scores": (
        ridge_scores,
        _RIDGE + "SELECT l_quantity, round(l_tax, 6) AS l_tax, round(1 / (1 + exp(-(b0 + b1 * l_quantity + b2 * l_tax))), 6) AS prob, "
        "count(*) AS n FROM study, fit GROUP BY ALL",
    ),
    "stepwise_path": (stepwise_path, _stepwise_sql()),
    "group_coefficients": (
        group_coefficients, _GROUPS + f"SELECT grp, feature, round(v, 5) AS importance FROM ({_GROUP_LONG})"
    ),
    "group_models_by_part": (
        group_models_by_part,
        _PARTS + "SELECT grp, feature, round(v, 5) AS importance FROM (SELECT DISTINCT grp FROM cells_all) LEFT JOIN fit USING (grp), "
        "LATERAL (VALUES ('l_quantity', b1), ('l_tax', b2)) t(feature, v)",
    ),
    "group_scores_by_part": (
        group_scores_by_part,
        _PARTS + "SELECT l_returnflag, round(sum(1 / (1 + exp(-(b0 + b1 * l_quantity + b2 * l_tax)))), 4) AS expected, count(b0) AS n "
        "FROM study LEFT JOIN fit ON grp = l_partkey GROUP BY 1",
    ),
    "group_importance_matrix": (
        group_importance_matrix,
        _GROUPS + "SELECT feature, "
        + ", ".join(f"round(max(v) FILTER (grp = '{g}'), 5) AS cluster_{g}" for g in ("A", "N", "R", "big"))
        + f" FROM ({_GROUP_LONG}) GROUP BY 1",
    ),
    "group_report": (group_report, _group_report_sql()),
    "group_report_all": (group_report_all, _group_report_all_sql()),
    "group_rmse": (
        group_rmse,
        _GROUPS + ", " + _GROUP_SCORED
        + " SELECT grp, round(sqrt(avg((y - pred) ** 2)), 6) AS rmse FROM p GROUP BY 1 UNION ALL SELECT 'big', NULL",
    ),
    "kmeans_centers": (
        kmeans_centers,
        _with(_SCALED_POINTS, lloyd("km", "pts", [6]))
        + "SELECT c::INTEGER AS cluster, d::INTEGER AS dim, round(x, 5) AS value FROM (SELECT c, unnest(ctr) AS x, generate_subscripts(ctr, 1) AS d FROM km_c)",
    ),
    "kmeans_sizes": (
        kmeans_sizes,
        _with(_SCALED_POINTS, lloyd("km", "pts", [6]))
        + "SELECT c::INTEGER AS cluster, count(*) AS n, sum(l_linenumber)::BIGINT AS lines FROM km_a JOIN pts USING (id) GROUP BY 1",
    ),
    "kmeans_elbow": (
        kmeans_elbow,
        _with(_SCALED_POINTS, lloyd("km", "pts", [1, 2, 3, 4]))
        + "SELECT k, round(sum(gap), 4) AS within_ss FROM km_a GROUP BY 1",
    ),
    "kmeans_embeddings": (
        kmeans_embeddings, _with(_EMB_POINTS, lloyd("km", "pts", [10])) + "SELECT id AS vec_id, c::INTEGER AS cluster FROM km_a"
    ),
    "elbow_embeddings": (
        elbow_embeddings,
        _with(_EMB_POINTS, lloyd("km", "pts", [1, 2, 5, 10])) + "SELECT k, round(sum(gap), 5) AS within_ss FROM km_a GROUP BY 1",
    ),
    "kmeans_elbow_20": (
        kmeans_elbow_20,
        _with(_SCALED_POINTS, _FOLDED_POINTS, lloyd("km", "folded", range(1, 21), weight="n"))
        + "SELECT k, round(sum(n * gap), 4) AS within_ss FROM km_a JOIN folded USING (id) GROUP BY 1",
    ),
    "elbow_embeddings_20": (
        elbow_embeddings_20,
        _with(_EMB_POINTS, lloyd("km", "pts", range(1, 21))) + "SELECT k, round(sum(gap), 5) AS within_ss FROM km_a GROUP BY 1",
    ),
    "kmeans_oversampled": (kmeans_oversampled, "SELECT 6::BIGINT AS clusters, count(*) AS n FROM lineitem"),
}
