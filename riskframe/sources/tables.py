"""CSV and Parquet scans, malformed-row quarantine, sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    mode: str = "PERMISSIVE",
    corrupt_col: str | None = None,
    header: bool = True,
    **options,
) -> DataFrame:
    """Scan CSV (with header) or Parquet.

    Without a schema the CSV types are inferred, which costs one more pass over the files.
    ``corrupt_col`` adds that column to the schema, so that Spark stores the text of every
    row it cannot parse; pruning inside the parser is turned off for such reads, because a
    pruned read would not look at the unread fields.
    """
    if fmt == "parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.options(**options).parquet(*([path] if isinstance(path, str) else path))
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}")
    reader = spark.read.option("header", header).option("mode", mode)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        if corrupt_col:
            schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_col).option("columnPruning", False)
        reader = reader.schema(schema)
    return reader.options(**options).csv(path)


def quarantine(df: DataFrame, corrupt_col: str = CORRUPT, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``.  Bad rows failed to parse and, if required columns are named, also
    lack one of them.  Every row lands in exactly one side."""
    # Spark parses only the fields a query asks for and judges a row by those; the hash asks for
    # all of them, so that a bare count finds the same bad rows as a full read
    every = F.hash(*[F.col(f"`{c}`") for c in df.columns if c != corrupt_col]).cast("string")
    is_bad = F.concat(F.col(corrupt_col), every).isNotNull()
    if required:
        is_bad = is_bad & reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    return df.filter(~is_bad).drop(corrupt_col), df.filter(is_bad)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    single_file: bool = False,
) -> None:
    """Overwrite ``path``.  ``single_file`` funnels all rows through one task: it is for
    report-sized frames that another tool reads as one file."""
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
