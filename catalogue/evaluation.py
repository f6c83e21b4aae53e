"""Evaluation tables on a scored frame derived from the order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.inputs import LINE_STUDY, line_study, rounded
from riskframe.operators import metrics as M

# a score on a grid of 0.02 that leans on the quantity, so that it has ties and some skill
SCORE = "l_quantity / 50"


def scored(spark, sf):
    lines = line_study(spark, sf).withColumn("prob", F.expr(SCORE))
    return lines.withColumn("pred", M.threshold("prob", 0.58)).withColumnRenamed("l_returnflag", "segment")


def threshold_labels(spark, sf):
    return scored(spark, sf).groupBy("prob", "pred").agg(F.count("*").alias("n"))


def confusion_counts(spark, sf):
    return M.confusion(scored(spark, sf))


def confusion_zero_cells(spark, sf):
    """A class that is never predicted still has its cells."""
    never = scored(spark, sf).withColumn("pred", F.lit(0))
    return M.confusion(never)


def report(spark, sf):
    return rounded(M.classification_report(scored(spark, sf)))


def report_never_predicted(spark, sf):
    return rounded(M.classification_report(scored(spark, sf).withColumn("pred", F.lit(0))))


def report_by_segment(spark, sf):
    return rounded(M.classification_report(scored(spark, sf), by=["segment"]))


def confusion_by_segment(spark, sf):
    return M.confusion(scored(spark, sf), by=["segment"])


def accuracy_overall(spark, sf):
    return rounded(M.accuracy(scored(spark, sf)))


def accuracy_by_segment(spark, sf):
    return rounded(M.accuracy(scored(spark, sf), by=["segment"]))


def rmse_overall(spark, sf):
    return rounded(M.rmse(scored(spark, sf)))


def rmse_by_segment(spark, sf):
    return rounded(M.rmse(scored(spark, sf), by=["segment"]))


def roc_points(spark, sf):
    return rounded(M.roc_curve(scored(spark, sf)))


def roc_points_all(spark, sf):
    return rounded(M.roc_curve(scored(spark, sf), drop_collinear=False))


def roc_fine_scores(spark, sf):
    """Scores with few ties: the price against its reach."""
    lines = line_study(spark, sf).withColumn("prob", F.expr("l_extendedprice / 110000"))
    return rounded(M.roc_curve(lines))


_S = (
    f"WITH {LINE_STUDY}, s AS (SELECT *, l_returnflag AS segment, {SCORE} AS prob, "
    f"CAST({SCORE} > 0.58 AS INTEGER) AS pred FROM study)"
)
_GRID = "(VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(actual, predicted)"


def _confusion_sql(pred: str) -> str:
    return (
        _S + f" SELECT actual, predicted, (SELECT count(*) FROM s WHERE y = actual AND {pred} = predicted) AS n FROM {_GRID}"
    )


def _report_sql(pred: str, by: str = "") -> str:
    part = f"{by}, " if by else ""
    return (
        _S + f", p AS (SELECT {part}y, {pred} AS pred FROM s), "
        f"c AS (SELECT {part}label, count(*) FILTER (y = label AND pred = label) AS hit, count(*) FILTER (pred = label) AS claimed, "
        f"count(*) FILTER (y = label) AS support FROM p, (VALUES (0), (1)) l(label) GROUP BY ALL), "
        f"m AS (SELECT {part}label, coalesce(hit / nullif(claimed, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r, support, hit FROM c), "
        f"f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM m), "
        f"t AS (SELECT {part}sum(support)::BIGINT AS total, sum(hit) / sum(support) AS acc, avg(p) AS mp, avg(r) AS mr, avg(f1) AS mf, "
        f"sum(p * support) / sum(support) AS wp, sum(r * support) / sum(support) AS wr, sum(f1 * support) / sum(support) AS wf FROM f "
        + (f"GROUP BY {by}" if by else "")
        + f"), o AS (SELECT {part}label::VARCHAR AS label, p, r, f1, support FROM f UNION ALL "
        f"SELECT {part}'accuracy', acc, acc, acc, total FROM t UNION ALL SELECT {part}'macro avg', mp, mr, mf, total FROM t "
        f"UNION ALL SELECT {part}'weighted avg', wp, wr, wf, total FROM t) "
        f"SELECT {part}label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM o"
    )


def _roc_sql(score: str, drop: bool) -> str:
    keep = "WHERE NOT coalesce(pos = next_pos AND neg = next_neg, false) OR k = 1" if drop else ""
    return (
        f"WITH {LINE_STUDY}, p AS (SELECT {score} AS threshold, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg "
        "FROM study GROUP BY 1), c AS (SELECT threshold, pos, neg, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, "
        "row_number() OVER w AS k, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS q "
        "FROM p WINDOW w AS (ORDER BY threshold DESC)) "
        "SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL "
        f"SELECT round(threshold, 6), round(fp / q, 6), round(tp / p, 6) FROM c {keep}"
    )


QUERIES = {
    "threshold_labels": (threshold_labels, _S + " SELECT prob, pred, count(*) AS n FROM s GROUP BY 1, 2"),
    "confusion_counts": (confusion_counts, _confusion_sql("pred")),
    "confusion_zero_cells": (confusion_zero_cells, _confusion_sql("0")),
    "confusion_by_segment": (
        confusion_by_segment,
        _S + " SELECT segment, actual, predicted, (SELECT count(*) FROM s WHERE y = actual AND pred = predicted AND "
        f"s.segment = z.segment) AS n FROM {_GRID}, (SELECT DISTINCT segment FROM s) z",
    ),
    "report": (report, _report_sql("pred")),
    "report_never_predicted": (report_never_predicted, _report_sql("0")),
    "report_by_segment": (report_by_segment, _report_sql("pred", "segment")),
    "accuracy_overall": (accuracy_overall, _S + " SELECT round(avg(CAST(y = pred AS INTEGER)), 6) AS accuracy FROM s"),
    "accuracy_by_segment": (
        accuracy_by_segment, _S + " SELECT segment, round(avg(CAST(y = pred AS INTEGER)), 6) AS accuracy FROM s GROUP BY 1"
    ),
    "rmse_overall": (rmse_overall, _S + " SELECT round(sqrt(avg((y - pred) ** 2)), 6) AS rmse FROM s"),
    "rmse_by_segment": (
        rmse_by_segment, _S + " SELECT segment, round(sqrt(avg((y - pred) ** 2)), 6) AS rmse FROM s GROUP BY 1"
    ),
    "roc_points": (roc_points, _roc_sql(SCORE, True)),
    "roc_points_all": (roc_points_all, _roc_sql(SCORE, False)),
    "roc_fine_scores": (roc_fine_scores, _roc_sql("l_extendedprice / 110000", True)),
}
