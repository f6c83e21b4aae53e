"""Cramér's V of all column pairs in one shuffle."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted
from riskframe.sources.scratch import materialize

DENSE = 65_536  # cells of a pair that are counted in a matrix; more are kept one by one
HELD_CELLS = 2_000_000  # cells that a task holds before it hands them on
CELLS = "i int, j int, a string, b string, n long"


class _Blocks:
    """Co-occurrence counts of all column pairs over the batches of one task.

    Labels become codes, column by column; code 0 stands for null.  A pair's counts are a dense
    matrix over its codes, or sorted (cell, count) where the matrix would be large."""

    def __init__(self, width: int):
        self.width = width
        self.codes: list[dict[str, int]] = [{} for _ in range(width)]
        self.counts: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def _encoded(self, f: int, column: pa.Array) -> np.ndarray:
        seen = column.dictionary_encode()
        known = self.codes[f]
        of_label = np.array([known.setdefault(v, len(known) + 1) for v in seen.dictionary.to_pylist()] + [0], dtype=np.int64)
        return of_label[seen.indices.fill_null(len(of_label) - 1).to_numpy(zero_copy_only=False)]

    def add(self, batch: pa.RecordBatch) -> None:
        codes = [self._encoded(f, batch.column(f)) for f in range(self.width)]
        sizes = [len(known) + 1 for known in self.codes]
        for i in range(self.width):
            for j in range(i + 1, self.width):
                if sizes[i] * sizes[j] <= DENSE:
                    flat = np.bincount(codes[i] * sizes[j] + codes[j], minlength=sizes[i] * sizes[j])
                    at = np.flatnonzero(flat)
                    keys, n = (at // sizes[j] << 32) + at % sizes[j], flat[at]
                else:
                    keys, n = np.unique((codes[i] << 32) + codes[j], return_counts=True)
                if (i, j) in self.counts:
                    keys, n = _merged(*self.counts[i, j], keys, n)
                self.counts[i, j] = (keys, n)

    def held(self) -> int:
        return sum(len(keys) for keys, _ in self.counts.values())

    def flush(self) -> Iterator[pa.RecordBatch]:
        labels = [pa.array([None, *known], pa.string()) for known in self.codes]
        for (i, j), (keys, n) in self.counts.items():
            a, b = keys >> 32, keys & 0xFFFFFFFF
            both = (a > 0) & (b > 0)
            size = int(both.sum())
            if size:
                columns = [np.full(size, i, np.int32), np.full(size, j, np.int32), labels[i].take(pa.array(a[both])), labels[j].take(pa.array(b[both])), n[both]]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["i", "j", "a", "b", "n"])
        self.__init__(self.width)


def _merged(keys: np.ndarray, n: np.ndarray, more: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if np.array_equal(keys, more):
        return keys, n + m
    every, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
    return every, np.bincount(at, np.concatenate([n, m]), len(every)).astype(np.int64)


def pair_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(i, j, a, b, n)`` for column positions i < j: the contingency counts of all pairs.

    No row is expanded to its pairs: every task counts label codes in blocks and hands on the
    cells it met, so the shuffle holds levels, not rows.  A task with very many cells hands them
    on as it goes.
    """
    rows = df.select(*[quoted(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)])
    width = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(width)
        for batch in batches:
            if batch.num_rows:
                blocks.add(batch)
                if blocks.held() > HELD_CELLS:
                    yield from blocks.flush()
        yield from blocks.flush()

    return rows.mapInArrow(run, CELLS).groupBy("i", "j", "a", "b").agg(F.sum("n").alias("n"))


def cramers_v(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Symmetric ``(var_a, var_b, v)`` with ones on the diagonal; no continuity correction.

    Uses chi2 / n = sum(o^2 / (row total * column total)) - 1, so empty cells need no rows.
    A column with one level has no defined V (null).  The counts are written once, since the
    row totals, column totals and sizes all start from them.
    """
    cols = list(cols)
    cells = materialize(pair_counts(df, cols), "pairs")
    pair = ["i", "j"]
    row = cells.groupBy(*pair, "a").agg(F.sum("n").alias("row_n"))
    col = cells.groupBy(*pair, "b").agg(F.sum("n").alias("col_n"))
    ratio = F.col("n") * F.col("n") / (F.col("row_n").cast("double") * F.col("col_n"))
    phi2 = cells.join(row, [*pair, "a"]).join(col, [*pair, "b"]).groupBy(*pair).agg((F.sum(ratio) - 1).alias("phi2"))
    shape = row.groupBy(*pair).agg(F.count("*").alias("r")).join(col.groupBy(*pair).agg(F.count("*").alias("c")), pair)
    freedom = F.least("r", "c") - 1
    v = F.when(freedom > 0, F.sqrt(F.greatest(F.col("phi2"), F.lit(0.0)) / freedom))
    upper = phi2.join(shape, pair).select("i", "j", v.alias("v"))

    names = F.array(*[F.lit(c) for c in cols])
    both = upper.select(F.inline(F.array(
        F.struct(names[F.col("i")].alias("var_a"), names[F.col("j")].alias("var_b"), F.col("v").alias("v")),
        F.struct(names[F.col("j")].alias("var_a"), names[F.col("i")].alias("var_b"), F.col("v").alias("v")),
    )))
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "var_a string, var_b string, v double")
    return both.unionByName(diagonal)


def top_pairs(v: DataFrame, k: int, exclude_diagonal: bool = True) -> DataFrame:
    """Largest k associations, each unordered pair once when the diagonal is excluded."""
    if exclude_diagonal:
        v = v.filter(F.col("var_a") < F.col("var_b"))
    return v.orderBy(F.col("v").desc_nulls_last(), "var_a", "var_b").limit(k)


def association_matrix(v: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Wide form: one row per variable, one column per variable."""
    return v.groupBy("var_a").pivot("var_b", list(cols)).agg(F.first("v"))


