"""Column-list helpers.  They look at ``df.columns`` only and start no job."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str):
    """Column by exact name, also when the name holds dots, commas or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    absent = missing_columns(cols, df)
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def missing_columns(names: Sequence[str], df: DataFrame) -> list[str]:
    """The names that ``df`` does not have, in the given order."""
    present = set(df.columns)
    return [n for n in names if n not in present]


def drop_matching(df: DataFrame, regex: str) -> DataFrame:
    return df.select(*[quoted(c) for c in df.columns if not re.search(regex, c)])


def rename_matching(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Apply regex replacements, in order, to every column name."""
    renamed = {}
    for c in df.columns:
        new = c
        for pattern, repl in rules:
            new = re.sub(pattern, repl, new)
        renamed[c] = new
    if len(set(renamed.values())) < len(renamed):
        raise ValueError("renaming would give two columns the same name")
    return df.select(*[quoted(c).alias(new) for c, new in renamed.items()])


def feature_columns(df: DataFrame, exclude: Sequence[str], sort: bool = True) -> list[str]:
    names = [c for c in df.columns if c not in set(exclude)]
    return sorted(names) if sort else names


def align(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exactly the given columns in the given order (test frame to train layout)."""
    return require_columns(df, cols).select(*[quoted(c) for c in cols])


def features_target(df: DataFrame, target: str, sort: bool = False) -> DataFrame:
    """One frame, features first and target last; Spark never needs to split and re-bind them."""
    return align(df, [*feature_columns(df, [target], sort), target])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def unpack_vector(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    values = vector_to_array(F.col(vector))
    return df.withColumns({n: values[i] for i, n in enumerate(names)})


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullable."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def head(df: DataFrame, n: int, order_by: Sequence) -> DataFrame:
    """First n rows of a stated order; Spark plans it as a bounded top-n."""
    return df.orderBy(*order_by).limit(n)
