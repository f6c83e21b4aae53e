"""Feature selection: full model, stepwise model, and the table of significant columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskframe.functions.columns import missing_columns
from riskframe.operators.design import dummy_columns, factors
from riskframe.operators.linear import INTERCEPT, LinearFit, glm_logit, select_significant
from riskframe.operators.stepwise import StepwiseFit, stepwise_logit


@dataclass
class Selection:
    full: LinearFit
    stepwise: StepwiseFit
    names: list[str]
    table: DataFrame


def select_features(
    df: DataFrame, y: str, terms: Sequence[str], factor_terms: Sequence[str] = (), alpha: float = 0.1, max_steps: int = 500
) -> Selection:
    """Columns whose coefficient in the stepwise model has p <= alpha, as 0/1 dummies or
    numbers, with the target last."""
    levels = factors(df, list(factor_terms))
    full = glm_logit(df, y, terms, levels)
    step = stepwise_logit(df, y, terms, levels, max_steps=max_steps)
    names = [name for name, _, _, _, p in step.fit.rows() if p is not None and p <= alpha and name != INTERCEPT]
    dummies = dummy_columns(df, levels)
    unknown = missing_columns(names, dummies)
    if unknown:
        raise ValueError(f"no column for: {', '.join(unknown)}")
    return Selection(full, step, names, select_significant(dummies, names, y))
