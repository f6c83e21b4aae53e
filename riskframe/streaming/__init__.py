"""Recodes and fitted models on a stream.

The recodes, the linear scores, the cluster labels and the tree scores are row-wise, so they
work on a streaming DataFrame as they are; nothing here keeps state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def each(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Chain row-wise steps for ``df.transform``."""

    def run(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return run
