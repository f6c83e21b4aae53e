"""Row keys, de-duplication, samples and train/test splits.

Splits are predicates on a hash of a stable key: train and test are the predicate and its
negation over one scan, with no join, no shuffle and no dependence on partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted
from riskframe.functions.keys import hash_hex, hash_unit

COPIES_PER_BLOCK = 100_000


def with_row_key(df: DataFrame, key_cols: Sequence[str] | None = None, name: str = "row_key") -> DataFrame:
    """Add a unique string key.

    With a natural key (unique columns) it is the hash of that key, a projection.  Without one
    it is the hash of all columns plus the number of the copy.  Equal rows are counted in a
    partial aggregate and written out again from their count, so a row that makes up a third
    of the table travels as one record per task; its copies are then spread in blocks.
    """
    if key_cols:
        return df.withColumn(name, hash_hex(key_cols))
    cols = df.columns
    counted = df.groupBy(*[quoted(c) for c in cols]).agg(F.count("*").alias("_n"))
    keyed = counted.withColumn("_h", hash_hex([quoted(c) for c in cols]))

    few = keyed.filter(F.col("_n") <= COPIES_PER_BLOCK).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))
    )
    blocks = keyed.filter(F.col("_n") > COPIES_PER_BLOCK).withColumn(
        "_start", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"), F.lit(COPIES_PER_BLOCK).cast("long")))
    )
    last = F.least(F.col("_n"), F.col("_start") + F.lit(COPIES_PER_BLOCK - 1))
    many = (
        blocks.repartition("_h", "_start")
        .withColumn("_copy", F.explode(F.sequence(F.col("_start"), last)))
        .drop("_start")
    )
    return few.unionByName(many).select(
        *[quoted(c) for c in cols], F.concat_ws("-", "_h", F.col("_copy").cast("string")).alias(name)
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` per key.  An aggregate, not a window: a key with
    a third of all rows is reduced inside each task before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order_by)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*[quoted(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def strata_fractions(df: DataFrame, label: str, frac: float) -> DataFrame:
    return df.select(label).distinct().withColumn("fraction", F.lit(float(frac)))


def in_test(key: Sequence[str], frac: float, seed: int):
    """Bernoulli(frac) decision of a row; use it where one labelled frame beats two frames."""
    return hash_unit(key, seed) < F.lit(float(frac))


def split_stratified(
    df: DataFrame, label: str, frac: float = 0.3, seed: int = 25, key: Sequence[str] = ("row_key",)
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: every stratum of ``label`` is sampled at ``frac`` by an independent
    draw per row.  Rows with a null label belong to no stratum and stay in train."""
    test = in_test(key, frac, seed) & F.col(label).isNotNull()
    return df.filter(~test), df.filter(test)


def split_exact(
    df: DataFrame, test_size: float = 0.3, seed: int = 123, key: Sequence[str] = ("row_key",)
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` with exactly ceil(test_size * n) test rows: those of lowest hash."""
    digest = hash_hex(key, seed)
    hashes = df.select(digest.alias("h"))
    n = hashes.count()
    cut = hash_cut(hashes, math.ceil(round(test_size * n, 9)))
    test = digest <= F.lit(cut)
    return df.filter(~test), df.filter(test)


def hash_cut(hashes: DataFrame, size: int) -> str:
    """The hash of rank ``size`` (from 1).  Each level counts rows per next four digits, at
    most 65,536 counts, and descends into the one bucket that holds the cut, so neither a sort
    of the table nor a window over it is needed."""
    if size <= 0:
        return ""
    prefix, want = "", size
    while len(prefix) < 32:
        inside = hashes.filter(F.col("h").startswith(prefix)) if prefix else hashes
        digits = F.substring("h", len(prefix) + 1, 4)
        counts = sorted(inside.groupBy(digits.alias("d")).count().collect())
        for d, c in counts:
            if want <= c:
                prefix, bucket = prefix + d, c
                break
            want -= c
        if want == bucket:
            return prefix + "f" * (32 - len(prefix))
    raise ValueError("the split key is not unique; add one with with_row_key")


def sample_n(df: DataFrame, n: int, seed: int = 25, key: Sequence[str] = ("row_key",)) -> DataFrame:
    """n random rows; planned as a bounded top-n, so each task passes on at most n rows."""
    return df.orderBy(hash_hex(key, seed), *key).limit(n)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def without(df: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``."""
    return df.join(other.select(*key), list(key), "left_anti")
