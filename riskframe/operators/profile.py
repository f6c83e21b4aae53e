"""Column profiles.  Each is one scan with partial aggregation; columns are stacked into
long form so that all of them share a single shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import numeric_columns, quoted, string_columns
from riskframe.operators.ranks import exact_quantiles

QUARTILES = {0.25: "q1", 0.5: "median", 0.75: "q3"}
ACCURACY = 10_000  # of sketched quartiles: their ranks are off by at most n / ACCURACY


def summarize(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Long ``(column, type, stat, value)``: min, q1, median, mean, q3, max of numeric columns,
    row count as ``length`` of string columns.  Nulls are left out of the numeric statistics.

    Exact quartiles shuffle the distinct values of each column; ``exact=False`` answers from
    a sketch in the same pass as the other statistics.
    """
    cols = list(df.columns if cols is None else cols)
    num = [c for c in numeric_columns(df) if c in cols]
    text = [c for c in string_columns(df) if c in cols]
    types = dict(df.dtypes)

    aggs, cells = [F.count("*").cast("double").alias("rows")], []

    def cell(column: str, stat: str, value: Column) -> None:
        cells.append(F.struct(
            F.lit(column).alias("column"), F.lit(types[column]).alias("type"), F.lit(stat).alias("stat"), value.alias("value")
        ))

    for i, c in enumerate(num):
        x = quoted(c).cast("double")
        for stat, f in (("min", F.min), ("mean", F.avg), ("max", F.max)):
            aggs.append(f(x).alias(f"{stat}{i}"))
            cell(c, stat, F.col(f"{stat}{i}"))
        if not exact:
            aggs.append(F.percentile_approx(x, list(QUARTILES), ACCURACY).alias(f"q{i}"))
            for k, stat in enumerate(QUARTILES.values()):
                cell(c, stat, F.col(f"q{i}")[k])
    for c in text:
        cell(c, "length", F.col("rows"))
    out = df.agg(*aggs).select(F.inline(F.array(*cells)))
    if not (num and exact):
        return out
    names = F.create_map(*[F.lit(x) for kv in QUARTILES.items() for x in kv])
    kinds = F.create_map(*[F.lit(x) for c in num for x in (c, types[c])])
    quartiles = exact_quantiles(df, num, list(QUARTILES)).select(
        "column", kinds[F.col("column")].alias("type"), names[F.col("prob")].alias("stat"), "value"
    )
    return out.unionByName(quartiles)


def sketch_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """How good the quartiles of ``summarize(exact=False)`` are: ``(column, stat, value, n, below,
    upto, within)``, where ``below`` and ``upto`` count the values under the quartile and up to it,
    and ``within`` says that its rank lies between them, give or take n / ACCURACY.

    Two scans with partial aggregates; three rows a column reach the driver.  Nulls are left
    out; a column without values has none of its own to judge: ``value`` and ``within`` are null."""
    probs = {stat: p for p, stat in QUARTILES.items()}
    sketched = summarize(df, cols, exact=False).where(F.col("stat").isin(*probs)).collect()
    aggs, cells = [], []
    for i, r in enumerate(sketched):
        x, v = quoted(r["column"]).cast("double"), F.lit(r["value"]).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(x < v).alias(f"b{i}"), F.count_if(x <= v).alias(f"u{i}")]
        n, below, upto, rank = F.col(f"n{i}"), F.col(f"b{i}"), F.col(f"u{i}"), F.col(f"n{i}") * probs[r["stat"]]
        slack = n / ACCURACY + 1
        fits = F.when(v.isNotNull(), (below <= rank + slack) & (upto >= rank - slack))
        cells.append(F.struct(
            F.lit(r["column"]).alias("column"), F.lit(r["stat"]).alias("stat"), v.alias("value"),
            n.alias("n"), below.alias("below"), upto.alias("upto"), fits.alias("within"),
        ))
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_null, n_nan, null_rate)``: one row per column from a single aggregate."""
    cols = list(df.columns if cols is None else cols)
    floats = {c for c, t in df.dtypes if t in ("double", "float")}
    aggs = [F.count("*").alias("_n")]
    for i, c in enumerate(cols):
        aggs.append(F.count_if(quoted(c).isNull()).alias(f"null{i}"))
        aggs.append((F.count_if(F.isnan(quoted(c))) if c in floats else F.lit(0).cast("long")).alias(f"nan{i}"))
    one = df.agg(*aggs)
    stacked = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"null{i}").alias("n_null"), F.col(f"nan{i}").alias("n_nan"))
            for i, c in enumerate(cols)
        ]
    )
    return one.select("_n", F.inline(stacked)).select(
        "column", "n_null", "n_nan", F.try_divide("n_null", "_n").alias("null_rate")
    )


def null_cells(df: DataFrame, key: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """``(key..., column)`` for every null or NaN cell."""
    cols = [c for c in (df.columns if cols is None else cols) if c not in key]
    floats = {c for c, t in df.dtypes if t in ("double", "float")}
    hit = F.array_compact(
        F.array(
            *[
                F.when(quoted(c).isNull() | (F.isnan(quoted(c)) if c in floats else F.lit(False)), F.lit(c))
                for c in cols
            ]
        )
    )
    return df.select(*[quoted(k) for k in key], F.explode(hit).alias("column"))


def distinct_values(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """``(column, value, n)``, values as text; ``approx`` gives ``(column, n_distinct)`` instead."""
    cols = list(df.columns if cols is None else cols)
    long = df.select(*[quoted(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    if approx:
        return long.groupBy("column").agg(F.approx_count_distinct("value").alias("n_distinct"))
    return long.groupBy("column", "value").agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, a: str, b: str, wide_levels: Sequence | None = None) -> DataFrame:
    """Contingency counts ``(a, b, n)``; with ``wide_levels`` of b one column per level."""
    if wide_levels is None:
        return df.groupBy(quoted(a), quoted(b)).agg(F.count("*").alias("n"))
    return df.groupBy(quoted(a)).pivot(b, list(wide_levels)).count().na.fill(0)


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*[quoted(c) for c in cols]).agg(F.count("*").alias("n"))


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """Largest k rows; ``ties`` makes the choice among equal values definite."""
    return df.orderBy(F.col(by).desc(), *ties).limit(k)


def group_keys(df: DataFrame, group: str) -> DataFrame:
    """The groups that occur, with sizes; unlike counting up to a maximum it is safe for gaps."""
    return df.groupBy(group).agg(F.count("*").alias("n"))
