"""Stepwise logistic selection by AIC.  Every candidate of a step is fitted in the same
passes, each from the parent's coefficients, over one cached design."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from riskframe.operators.design import Design, design
from riskframe.operators.linear import FitRows, LinearFit, LogitSet, finish, fit_logits, fit_rows


@dataclass
class StepwiseFit:
    path: list[tuple]  # (step, action, term, df, deviance, aic)
    terms: list[str]
    fit: LinearFit

    def path_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.path, "step int, action string, term string, n_coef int, deviance double, aic double"
        )


def _aic(s: LogitSet) -> float:
    return s.deviance + 2 * (len(s.cols) + 1)


def _start_from(parent: LogitSet, cols: list[int]) -> np.ndarray:
    known = dict(zip([-1, *parent.cols], parent.best))
    return np.array([known.get(c, 0.0) for c in [-1, *cols]])


def candidate_fits(
    rows: FitRows,
    d: Design,
    terms: Sequence[str],
    scope: Sequence[str],
    parent: LogitSet,
    direction: str,
    usable: set[int],
) -> list[tuple[str, str, LogitSet]]:
    """All one-term moves from ``terms``: drops in model order, then adds in scope order."""
    moves = []
    if direction in ("both", "backward"):
        moves += [("drop", t) for t in terms]
    if direction in ("both", "forward"):
        moves += [("add", t) for t in scope if t not in terms]
    sets = []
    for action, t in moves:
        kept = [u for u in terms if u != t] if action == "drop" else [*terms, t]
        # a column that is aliased in the full design stays out of every candidate
        cols = [c for c in d.positions(kept) if c in usable]
        sets.append(LogitSet(cols, start=_start_from(parent, cols)))
    fit_logits(rows, sets)
    return [(action, t, s) for (action, t), s in zip(moves, sets)]


def stepwise_logit(
    df: DataFrame,
    y: str,
    terms: Sequence[str],
    levels: Mapping[str, Sequence[str]] | None = None,
    direction: str = "both",
    max_steps: int = 500,
) -> StepwiseFit:
    """Start from the full model, move to the best one-term change while AIC falls.  A factor
    enters and leaves as a whole; ties go to the earlier move, staying put first."""
    scope = list(terms)
    d = design(df, scope, levels)
    rows = fit_rows(df, y, d.columns)
    try:
        current = list(scope) if direction != "forward" else []
        full = LogitSet(d.positions(current))
        fit_logits(rows, [full])
        usable = set(full.cols) if direction != "forward" else set(range(len(d.names)))
        path = [(0, "start", "", len(full.cols) + 1, full.deviance, _aic(full))]
        model = full
        for step in range(1, max_steps + 1):
            moves = candidate_fits(rows, d, current, scope, model, direction, usable)
            best = min(moves, key=lambda m: _aic(m[2]), default=None)
            if best is None or _aic(best[2]) >= _aic(model):
                break
            action, term, model = best
            current = [t for t in current if t != term] if action == "drop" else [*current, term]
            path.append((step, action, term, len(model.cols) + 1, model.deviance, _aic(model)))
        return StepwiseFit(path, current, finish(rows, model, d))
    finally:
        rows.release()
