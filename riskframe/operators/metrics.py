"""Evaluation tables from a scored frame (key, y, prob, pred[, group]).

Everything derives from the (group, actual, predicted) counts, one partial aggregate over the
scored rows; the arithmetic after it works on a few rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ranks import running_totals


def threshold(prob: str | Column, t: float) -> Column:
    """1 where the probability is strictly above t."""
    p = F.col(prob) if isinstance(prob, str) else prob
    return (p > F.lit(float(t))).cast("int")


def _labelled(df: DataFrame, y: str, pred: str, nulls: str) -> DataFrame:
    """Rows without a label or a prediction stop the run, or (label) count as a label "null"."""
    if nulls == "error":
        fail = lambda c: F.coalesce(F.col(c), F.raise_error(F.lit(f"null in {c}")).cast(df.schema[c].dataType))
        return df.withColumns({c: fail(c) for c in (y, pred)})
    if nulls == "label":
        return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in (y, pred)})
    raise ValueError(f"nulls must be 'error' or 'label', got {nulls!r}")


def confusion(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = (), nulls: str = "error") -> DataFrame:
    """``(by..., actual, predicted, n)`` with zero cells: labels are all that occur on either
    side of the group.  ``nulls``: rows without a label or prediction are an error, or count
    under the label "null" (labels are then strings)."""
    by = list(by)
    df = _labelled(df, y, pred, nulls)
    counts = df.groupBy(*by, F.col(y).alias("actual"), F.col(pred).alias("predicted")).agg(F.count("*").alias("n"))
    # per group: label set, then its square by two explodes; a few labels per group
    labels = counts.groupBy(*by).agg(
        F.array_distinct(F.concat(F.collect_set("actual"), F.collect_set("predicted"))).alias("_labels")
    )
    grid = labels.withColumn("actual", F.explode("_labels")).withColumn("predicted", F.explode("_labels")).drop("_labels")
    return grid.join(counts, [*by, "actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def classification_report(
    df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = (), nulls: str = "error"
) -> DataFrame:
    """Long ``(by..., label, precision, recall, f1, support)``: one row per class, then
    ``accuracy``, ``macro avg`` and ``weighted avg``; an undefined ratio is 0.  ``nulls`` as in
    ``confusion``."""
    by = list(by)
    cells = confusion(df, y, pred, by, nulls)
    stacked = cells.select(*by, F.inline(F.array(
        F.struct(F.col("actual").cast("string").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("claimed"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("predicted").cast("string").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("claimed"),
                 F.lit(0).cast("long").alias("hit")),
    )))
    sums = stacked.groupBy(*by, "label").agg(*[F.sum(c).alias(c) for c in ("support", "claimed", "hit")])

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    classes = sums.withColumns({"precision": ratio("hit", "claimed"), "recall": ratio("hit", "support")}).withColumn(
        "f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )
    measures = ["precision", "recall", "f1"]
    totals = classes.groupBy(*by).agg(
        F.sum("support").alias("total"),
        F.sum("hit").alias("hits"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"weighted_{m}") for m in measures],
    )
    summary = totals.select(*by, F.inline(F.array(
        _report_row("accuracy", *[F.col("hits") / F.col("total")] * 3),
        _report_row("macro avg", *[F.col(f"macro_{m}") for m in measures]),
        _report_row("weighted avg", *[F.col(f"weighted_{m}") for m in measures]),
    )))
    return classes.select(*by, "label", *measures, "support").unionByName(summary)


def _report_row(label: str, precision: Column, recall: Column, f1: Column) -> Column:
    return F.struct(
        F.lit(label).alias("label"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
        F.col("total").alias("support"),
    )


def accuracy(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = (), nulls: str = "error") -> DataFrame:
    df = _labelled(df, y, pred, nulls)
    return df.groupBy(*by).agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"))


def rmse(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Root mean squared error; on labels it is the square root of the error rate."""
    gap = F.col(y).cast("double") - F.col(pred).cast("double")
    return df.groupBy(*by).agg(F.sqrt(F.avg(gap * gap)).alias("rmse"))


def roc_curve(df: DataFrame, y: str = "y", prob: str = "prob", drop_collinear: bool = True) -> DataFrame:
    """``(threshold, fpr, tpr)`` from (inf, 0, 0) down to the lowest score.

    One point per distinct score; with ``drop_collinear`` a point is left out when it lies on
    the line between its neighbours with equal steps, the first and last scores excepted.
    Scores are collapsed before anything is sorted and the running counts are bucketed.
    """
    points = df.groupBy(F.col(prob).alias("threshold")).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).alias("neg"),
    )
    steps = points.withColumn("step", F.struct("pos", "neg"))
    run = running_totals(steps, "threshold", ["pos", "neg"], descending=True, following=["step"])
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    if drop_collinear:
        bend = F.col("next_step").isNull() | (F.col("step") != F.col("next_step"))
        run = run.filter(bend | first)
    fpr, tpr = F.try_divide("cum_neg", "total_neg"), F.try_divide("cum_pos", "total_pos")
    point = F.struct(F.col("threshold").cast("double").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))
    origin = F.struct(F.lit(float("inf")).alias("threshold"), (fpr * 0).alias("fpr"), (tpr * 0).alias("tpr"))
    return run.select(F.inline(F.when(first, F.array(origin, point)).otherwise(F.array(point))))
