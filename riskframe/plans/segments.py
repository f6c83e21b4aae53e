"""Segmentation: rescaled k-means, then one logistic model per segment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskframe.operators.cluster import KMeansFit, kmeans, scaled_vector
from riskframe.operators.linear import GroupFits, importance_matrix, per_group_logit
from riskframe.operators.metrics import classification_report, rmse


@dataclass
class Segments:
    clusters: KMeansFit
    rows: DataFrame
    models: GroupFits
    report: DataFrame
    rmse: DataFrame
    importance: DataFrame


def segment_risk(
    df: DataFrame, y: str, x: Sequence[str], k: int = 6, seed: int = 25, threshold: float = 0.58, cluster_on: Sequence[str] | None = None
) -> Segments:
    """Cluster on the rescaled columns (the target is one of them unless ``cluster_on`` says
    otherwise), label the unscaled rows and fit, score and report each cluster in-sample.  A cluster
    of one class has no model: the report counts its rows under the predicted label "null"."""
    columns = list(cluster_on) if cluster_on is not None else [*x, y]
    vectors = scaled_vector(df, columns)
    clusters = kmeans(vectors, "features", k, seed)
    rows = clusters.predict(vectors).drop("features")
    models = per_group_logit(rows, "cluster", y, x)
    scored = models.score(rows, threshold=threshold)
    importance = models.to_df(df.sparkSession)
    ids = sorted(models.fits)
    return Segments(
        clusters, rows, models,
        classification_report(scored, y, by=["cluster"], nulls="label"),
        rmse(scored, y, by=["cluster"]),
        importance_matrix(importance, "cluster", ids),
    )
