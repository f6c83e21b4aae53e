"""Factors, dummy columns and treatment-coded designs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted, require_columns
from riskframe.operators.ranks import numbered


def factor(df: DataFrame, col: str, levels: Sequence[str] | None = None, baseline: str = "first") -> list[str]:
    """Level list of a string column, sorted, the baseline at the front.  ``baseline`` is
    ``first`` or one of the levels."""
    return factors(df, [col], {col: levels} if levels else None, {col: baseline})[col]


def check_levels(df: DataFrame, cols: Sequence[str], max_levels: int) -> None:
    """Raise before the levels of an identifier-like column are listed in one place."""
    sizes = df.agg(*[F.approx_count_distinct(quoted(c)).alias(f"d{i}") for i, c in enumerate(cols)]).first()
    wide = [c for i, c in enumerate(cols) if sizes[f"d{i}"] > max_levels]
    if wide:
        raise ValueError(f"too many levels for a factor: {', '.join(wide)}")


def factors(
    df: DataFrame,
    cols: Sequence[str],
    levels: Mapping[str, Sequence[str]] | None = None,
    baselines: Mapping[str, str] | None = None,
    max_levels: int = 10_000,
) -> dict[str, list[str]]:
    """Level lists of several columns from one job.  Levels become model columns, so a column
    with more than ``max_levels`` is a mistake in the call and raises; ``factor_table`` lists those."""
    known = {c: list(v) for c, v in (levels or {}).items()}
    todo = [c for c in cols if c not in known]
    if todo:
        check_levels(df, todo, max_levels)
        long = df.select(*[quoted(c).cast("string").alias(c) for c in todo]).unpivot([], todo, "column", "level")
        for r in long.dropna().distinct().collect():
            known.setdefault(r["column"], []).append(r["level"])
        for c in todo:
            known[c] = sorted(known.get(c, []))
    for c, base in (baselines or {}).items():
        if base != "first":
            known[c] = [base, *[v for v in known[c] if v != base]]
    return {c: known[c] for c in cols}


def factor_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, position, level)``: the sorted levels of any number of columns as a table, for
    columns with more levels than a model could have."""
    long = df.select(*[quoted(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "level")
    placed = numbered(long.dropna().distinct(), ["column", "level"], "_place", "levels")
    first = placed.groupBy("column").agg(F.min("_place").alias("_first"))  # one row per column
    return placed.join(F.broadcast(first), "column").select("column", (F.col("_place") - F.col("_first")).alias("position"), "level")


def _is_level(col: str, level: str) -> Column:
    c = quoted(col)
    return F.when(c.isNotNull(), F.when(c.cast("string") == level, F.lit(1)).otherwise(F.lit(0)))


def dummy_columns(df: DataFrame, levels: Mapping[str, Sequence[str]], sep: str = "", keep: Sequence[str] = ()) -> DataFrame:
    """Every factor as 0/1 columns ``<var><sep><level>``, all levels kept; other columns stay.
    A null label gives null in all its dummies."""
    out = []
    for c in df.columns:
        if c in levels:
            if c in keep:
                out.append(quoted(c))
            out.extend(_is_level(c, v).alias(f"{c}{sep}{v}") for v in levels[c])
        else:
            out.append(quoted(c))
    return df.select(*out)


@dataclass(frozen=True)
class Design:
    """Treatment-coded design: column names and the term each one belongs to."""

    names: list[str]
    term_of: dict[str, str]
    columns: list[Column]

    @property
    def terms(self) -> list[str]:
        return list(dict.fromkeys(self.term_of.values()))

    def positions(self, terms: Sequence[str]) -> list[int]:
        wanted = set(terms)
        return [i for i, n in enumerate(self.names) if self.term_of[n] in wanted]


def design(df: DataFrame, terms: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None) -> Design:
    """Numeric terms as they are, factor terms as dummies without their first level."""
    require_columns(df, terms)
    levels = levels or {}
    names, term_of, columns = [], {}, []
    for t in terms:
        if t in levels:
            for v in levels[t][1:]:
                names.append(f"{t}{v}")
                term_of[names[-1]] = t
                columns.append(_is_level(t, v).cast("double"))
        else:
            names.append(t)
            term_of[t] = t
            columns.append(quoted(t).cast("double"))
    if len(set(names)) < len(names):
        raise ValueError("two design columns would share a name")
    return Design(names, term_of, columns)


def design_frame(df: DataFrame, terms: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The design as named columns, next to the columns to keep."""
    d = design(df, terms, levels)
    return df.select(*[quoted(c) for c in keep], *[c.alias(n) for c, n in zip(d.columns, d.names)])
