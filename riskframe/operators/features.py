"""Scaling, cleaning and encoding.  Each fit is one aggregate job whose result is a handful
of numbers per column; each transform is one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.columns import quoted, require_columns
from riskframe.operators.lookup import dimension_join
from riskframe.operators.ranks import exact_quantiles, numbered

LISTED_LABELS = 100_000  # labels up to which a fitted dictionary travels with the plan; more stay a table


def assemble(df: DataFrame, cols: Sequence[str], out: str, on_null: str = "error") -> DataFrame:
    """Numeric columns to one ML vector; ``on_null``: error, keep or skip."""
    require_columns(df, cols)
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=on_null).transform(df)


def minmax_scale(
    df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None, suffix: str = "_scaled"
) -> DataFrame:
    """Min-max to [0, 1]; a constant column becomes 0.5, nulls stay null.

    ``fit_on`` takes the ranges from another frame (the training rows), so that test rows do
    not leak into them.  An empty suffix scales in place.
    """
    source = require_columns(df, cols) if fit_on is None else fit_on
    stats = source.agg(
        *[F.min(quoted(c)).cast("double").alias(f"lo{i}") for i, c in enumerate(cols)],
        *[F.max(quoted(c)).cast("double").alias(f"hi{i}") for i, c in enumerate(cols)],
    ).first()
    out = {}
    for i, c in enumerate(cols):
        lo, hi, x = stats[f"lo{i}"], stats[f"hi{i}"], quoted(c).cast("double")
        if lo is None:
            scaled = F.lit(None).cast("double")
        elif lo == hi:
            scaled = F.when(x.isNotNull(), F.lit(0.5))
        else:
            scaled = (x - F.lit(lo)) / F.lit(hi - lo)
        out[c + suffix] = scaled
    return df.withColumns(out)


def quantile_bounds(
    df: DataFrame, cols: Sequence[str], lo: float, hi: float, rel_error: float, exact: bool
) -> dict[str, tuple]:
    if exact:
        found = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, cols, [lo, hi]).collect()}
        return {c: (found[(c, lo)], found[(c, hi)]) for c in cols if (c, lo) in found}
    bounds = df.approxQuantile(list(cols), [lo, hi], rel_error)
    return {c: tuple(b) for c, b in zip(cols, bounds) if b}


def winsorize(
    df: DataFrame,
    cols: Sequence[str],
    lo: float = 0.01,
    hi: float = 0.99,
    rel_error: float = 0.001,
    exact: bool = False,
) -> DataFrame:
    """Clamp to the [lo, hi] quantiles; nulls stay null.

    All columns share one sketch pass.  ``rel_error`` is a rank error: it has to stay well
    under ``lo``, else the sketch may answer with the minimum and clamp nothing.
    """
    if not exact and rel_error > lo / 2:
        raise ValueError("rel_error must be at most half of the lower quantile")
    bounds = quantile_bounds(df, cols, lo, hi, rel_error, exact)
    clamped = {}
    for c, (low, high) in bounds.items():
        x = quoted(c).cast("double")
        clamped[c] = F.when(x < low, F.lit(low)).when(x > high, F.lit(high)).otherwise(x)
    return df.withColumns(clamped)


def impute(
    df: DataFrame, cols: Sequence[str], strategy: str = "mean", suffix: str = "_imp"
) -> DataFrame:
    """Fill nulls and NaNs of numeric columns into ``<col><suffix>``, typed double, with their
    mean, exact median or mode."""
    clean = {c: F.nanvl(quoted(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    if strategy == "mean":
        row = df.agg(*[F.avg(x).alias(f"v{i}") for i, x in enumerate(clean.values())]).first()
        fill = {c: row[f"v{i}"] for i, c in enumerate(cols)}
    elif strategy == "median":
        fill = {r["column"]: r["value"] for r in exact_quantiles(df, cols, [0.5]).collect()}
    elif strategy == "mode":
        values = df.select(*[x.alias(c) for c, x in clean.items()]).unpivot([], list(cols), "column", "value")
        counts = values.dropna().groupBy("column", "value").count()
        # most frequent, smallest value on ties
        best = counts.groupBy("column").agg(F.max_by("value", F.struct("count", -F.col("value"))).alias("value"))
        fill = {r["column"]: r["value"] for r in best.collect()}
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return df.withColumns({c + suffix: F.coalesce(clean[c], F.lit(fill.get(c)).cast("double")) for c in cols})


def category_index(df: DataFrame, cols: Sequence[str], order: str = "frequencyDesc") -> DataFrame:
    """Fitted dictionary ``(column, label, n, idx)``; one shuffle for all columns.  Labels are
    numbered in ranges of their order, so a column may have any number of them."""
    labels = df.select(*[quoted(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "label")
    counts = labels.dropna().groupBy("column", "label").agg(F.count("*").alias("n"))
    sort = {
        "frequencyDesc": [F.col("n").desc(), F.col("label")],
        "frequencyAsc": [F.col("n"), F.col("label")],
        "alphabetAsc": [F.col("label")],
        "alphabetDesc": [F.col("label").desc()],
    }[order]
    placed = numbered(counts, ["column", *sort], "_place", "categories")
    first = placed.groupBy("column").agg(F.min("_place").alias("_first"))  # one row per column
    return placed.join(F.broadcast(first), "column").select("column", "label", "n", (F.col("_place") - F.col("_first")).cast("int").alias("idx"))


def index_categories(
    df: DataFrame, cols: Sequence[str], order: str = "frequencyDesc", invalid: str = "keep", suffix: str = "_idx"
) -> DataFrame:
    """Label indices by frequency (ties by label); ``invalid``: null labels get one extra index
    (keep), lose their row (skip) or raise (error).

    A column with few labels has its dictionary in the plan.  That of a column with many stays a
    table and is joined, with the rows of frequent labels spread.
    """
    require_columns(df, cols)
    sizes = df.agg(*[F.approx_count_distinct(quoted(c)).alias(f"d{i}") for i, c in enumerate(cols)]).first()
    wide = [c for i, c in enumerate(cols) if sizes[f"d{i}"] > LISTED_LABELS]
    narrow = [c for c in cols if c not in wide]
    if narrow:
        df = StringIndexer(
            inputCols=narrow, outputCols=[c + suffix for c in narrow], stringOrderType=order, handleInvalid=invalid
        ).fit(df).transform(df)
    if wide:
        dictionary = category_index(df, wide, order)
        sums = dictionary.groupBy("column").agg(F.count("*").alias("labels"), F.sum("n").alias("rows")).collect()
        size = {r["column"]: (r["labels"], r["rows"]) for r in sums}
    for c in wide:
        labels, rows = size[c]
        own = dictionary.where(F.col("column") == c).select("label", F.col("idx").cast("double").alias(c + suffix), "n")
        df = dimension_join(df, c, own, "label", [c + suffix], hot=_frequent(own, rows))
        missing = quoted(c + suffix).isNull()
        if invalid == "skip":
            df = df.where(~missing)
        else:
            other = F.lit(float(labels)) if invalid == "keep" else F.raise_error(F.lit(f"a label of {c} is null")).cast("double")
            df = df.withColumn(c + suffix, F.when(missing, other).otherwise(quoted(c + suffix)))
    return df


def _frequent(dictionary: DataFrame, rows: int, share: float = 0.005) -> list[str]:
    """Labels with more than a given share of the rows: at most 1 / share of them."""
    return [r["label"] for r in dictionary.where(F.col("n") > share * rows).select("label").collect()]


def one_hot(df: DataFrame, cols: Sequence[str], drop_last: bool = False, suffix: str = "_oh") -> DataFrame:
    """Index columns to sparse one-hot vectors, no level dropped by default."""
    encoder = OneHotEncoder(inputCols=list(cols), outputCols=[c + suffix for c in cols], dropLast=drop_last)
    return encoder.fit(df).transform(df)


def clean_pipeline(
    numeric: Sequence[str], categorical: Sequence[str], strategy: str = "mean", order: str = "frequencyDesc"
) -> Pipeline:
    """Unfitted ML pipeline: imputer, then indexers and encoders for all categorical columns.

    The imputer writes doubles only for double or float input; cast integer columns first,
    because Spark truncates the mean of an integer column.
    """
    stages = []
    if numeric:
        stages.append(
            Imputer(inputCols=list(numeric), outputCols=[f"{c}_imp" for c in numeric], strategy=strategy)
        )
    if categorical:
        index = [f"{c}_idx" for c in categorical]
        stages.append(
            StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep", stringOrderType=order)
        )
        stages.append(
            OneHotEncoder(inputCols=index, outputCols=[f"{c}_oh" for c in categorical], dropLast=False)
        )
    return Pipeline(stages=stages)


def as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: quoted(c).cast(T.DoubleType()) for c in cols})
