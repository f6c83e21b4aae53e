"""Path-dependent Tree SHAP over all rows, in Arrow batches.

For one leaf, let P be the features on its path, o_j = 1 if the row meets every condition on
feature j along the path and z_j the product of the cover shares there.  The leaf's share of
feature i is value * (o_i - z_i) * sum_k k!(d-k-1)!/d! e_k, where e_k are the coefficients of
the product over j != i of (z_j + o_j t).  Rows with the same o pattern get equal shares, so
each leaf is worked out once per pattern that occurs in a batch."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted
from riskframe.operators.boost import Booster
from riskframe.operators.intervals import GREATEST, LEAST
from riskframe.operators.partials import matrix
from riskframe.operators.trees import Tree, feature_array


SMALL_PATH = 6  # up to 64 patterns are worked out without looking which occur


def leaf_paths(tree: Tree) -> list[tuple[float, list[tuple[int, int, int]], dict[int, float]]]:
    """Per leaf: value, bin range ``(feature, low, high]`` per path feature, cover share."""
    out = []
    stack = [(0, {}, {})]
    while stack:
        i, ranges, shares = stack.pop()
        f = int(tree.feature[i])
        if f < 0:
            out.append((float(tree.value[i]), [(g, lo, hi) for g, (lo, hi) in ranges.items()], shares))
            continue
        lo, hi = ranges.get(f, (LEAST, GREATEST))
        cut = int(tree.cut[i])
        for child, bounds in ((tree.left[i], (lo, min(hi, cut))), (tree.right[i], (max(lo, cut), hi))):
            share = float(tree.cover[child] / tree.cover[i]) if tree.cover[i] else 0.0
            stack.append((int(child), {**ranges, f: bounds}, {**shares, f: shares.get(f, 1.0) * share}))
    return out


def expected_margin(model: Booster) -> float:
    """Cover-weighted mean margin: the base value of the SHAP decomposition."""
    total = model.base
    for tree in model.trees:
        total += sum(value * float(np.prod(list(shares.values()))) for value, _, shares in leaf_paths(tree))
    return total


def pattern_shares(patterns: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Shares of each path feature for 0/1 patterns (U, d) and cover shares z (d,)."""
    u, d = patterns.shape
    weight = np.array([factorial(k) * factorial(d - k - 1) / factorial(d) for k in range(d)])
    out = np.empty((u, d))
    for i in range(d):
        coef = np.zeros((u, d))
        coef[:, 0] = 1.0
        for j in range(d):
            if j != i:
                shifted = np.zeros_like(coef)
                shifted[:, 1:] = coef[:, :-1] * patterns[:, [j]]
                coef = coef * z[j] + shifted
        out[:, i] = (patterns[:, i] - z[i]) * (coef @ weight)
    return out


def batch_shap(model: Booster, paths: list, bins: np.ndarray) -> np.ndarray:
    phi = np.zeros((len(bins), len(model.cuts.features)))
    for value, ranges, shares in paths:
        if not ranges:
            continue
        features = [f for f, _, _ in ranges]
        code = np.zeros(len(bins), dtype=np.int64)
        for bit, (f, lo, hi) in enumerate(ranges):
            code |= ((bins[:, f] > lo) & (bins[:, f] <= hi)).astype(np.int64) << bit
        if len(ranges) <= SMALL_PATH:
            seen, which = np.arange(1 << len(ranges)), code
        else:
            seen, which = np.unique(code, return_inverse=True)
        patterns = (seen[:, None] >> np.arange(len(ranges)) & 1).astype(float)
        z = np.array([shares[f] for f in features])
        phi[:, features] += value * pattern_shares(patterns, z)[which]
    return phi


def tree_shap(df: DataFrame, model: Booster, key: Sequence[str], values: bool = False) -> DataFrame:
    """``(key..., feature, shap)`` in margin units for every row; the values of a row and the
    expected margin add up to its margin.  With ``values`` also the feature's ``value``, told in
    the same pass."""
    names = list(model.cuts.features)
    paths = [p for tree in model.trees for p in leaf_paths(tree)]
    keyed = df.select(*[quoted(k) for k in key], feature_array(names).alias("_x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = matrix(batch, "_x")
            phi = batch_shap(model, paths, model.cuts.bin(x))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            told = [_lists(phi), _lists(x)] if values else [_lists(phi)]
            yield pa.RecordBatch.from_arrays([*columns, *told], names=[*key, "_phi", "_value"][: len(key) + len(told)])

    kinds = dict(keyed.dtypes)
    lists = ["_phi array<double>", "_value array<double>"] if values else ["_phi array<double>"]
    wide = keyed.mapInArrow(run, ", ".join([*[f"`{k}` {kinds[k]}" for k in key], *lists]))
    labels = F.array(*[F.lit(n) for n in names])
    held = [*[quoted(k) for k in key], *([F.col("_value")] if values else [])]
    long = wide.select(*held, F.posexplode("_phi").alias("_i", "shap"))
    own = [F.col("_value")[F.col("_i")].alias("value")] if values else []
    return long.select(*[quoted(k) for k in key], labels[F.col("_i")].alias("feature"), *own, "shap")


def _lists(rows: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(rows, dtype=float).ravel()
    return pa.FixedSizeListArray.from_arrays(pa.array(flat), rows.shape[1]).cast(pa.list_(pa.float64()))


def base_value(model: Booster, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(expected_margin(model),)], "base_value double")


def shap_summary(shap: DataFrame) -> DataFrame:
    """Mean absolute value per feature, largest first."""
    return (
        shap.groupBy("feature")
        .agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
        .orderBy(F.col("mean_abs_shap").desc(), "feature")
    )


def shap_values(df: DataFrame, model: Booster, key: Sequence[str]) -> DataFrame:
    """Long table ``(key..., feature, value, shap)``: each contribution beside its feature value."""
    return tree_shap(df, model, key, values=True)
