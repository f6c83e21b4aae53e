"""k-means by Lloyd passes; several numbers of clusters share every pass.

A pass assigns the cached vectors to the centers of all models at once and returns, per
model and cluster, the count, the vector sum and the sum of squared distances."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted
from riskframe.functions.keys import hash_hex
from riskframe.operators.features import minmax_scale
from riskframe.operators.partials import dense, matrix, summed
from riskframe.operators.placement import keep_for_passes, occupied_partitions, with_task


def _assign(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest center (lowest id on ties) and squared distance to it."""
    best = np.zeros(len(x), dtype=np.int64)
    gap = np.full(len(x), np.inf)
    for c, center in enumerate(centers):
        d = ((x - center) ** 2).sum(axis=1)
        closer = d < gap
        best[closer], gap[closer] = c, d[closer]
    return best, gap


ROUNDING = 2.0**-21  # of single precision, per term of a distance, with room
STRIP = 4_096  # rows whose distances to the centers of a model stay in the processor's cache


def _assign_many(x: np.ndarray, models: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same for several sets of centers: matrix products in single precision bound all distances,
    strip by strip, and only rows with more than one center within their rounding of the nearest
    are measured exactly."""
    middle = np.mean([model.mean(axis=0) for model in models], axis=0)
    near_middle = [(model - middle).astype(np.float32) for model in models]
    half = [(model.astype(float) ** 2).sum(axis=1)[:, None].astype(np.float32) / 2 for model in near_middle]
    longest = max(2 * float(h.max()) for h in half)
    out = [(np.zeros(len(x), dtype=np.int64), np.zeros(len(x))) for _ in models]
    for at in range(0, len(x), STRIP):
        part = x[at : at + STRIP]
        columns = np.ascontiguousarray(part.T)
        turned = columns - middle[:, None]
        room = (ROUNDING * (len(columns) + 4) * ((turned**2).sum(axis=0) + longest)).astype(np.float32)
        turned = turned.astype(np.float32)
        for model, shifted, lengths, (best, gap) in zip(models, near_middle, half, out):
            own, away = best[at : at + STRIP], gap[at : at + STRIP]
            if len(model) > 1:
                score = shifted @ turned
                np.subtract(lengths, score, out=score)
                # how many centers are near, and which it is where that is one
                near = (score <= score.min(axis=0) + room).astype(np.min_scalar_type(len(model)))
                many = near.sum(axis=0, dtype=near.dtype)
                own[:] = (near * np.arange(len(model), dtype=near.dtype)[:, None]).sum(axis=0, dtype=near.dtype)
                close = np.flatnonzero(many != 1)
                if len(close):
                    own[close] = _assign(part[close], model)[0]
            for column, values in zip(columns, np.ascontiguousarray(model.T)):
                away += (column - values.take(own)) ** 2
    return out


@dataclass
class KMeansFit:
    k: int
    vector: str
    centers: np.ndarray
    within_ss: float
    iterations: int
    sizes: np.ndarray

    def predict(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        """Add the cluster id, from 1, beside the untouched columns of the row."""
        centers = self.centers

        @F.arrow_udf("int")
        def nearest(x: pa.Array) -> pa.Array:
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            return pa.array((_assign(rows, centers)[0] + 1).astype(np.int32))

        return df.withColumn(out, nearest(F.col(self.vector)))

    def centers_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (c + 1, d + 1, float(v)) for c, center in enumerate(self.centers) for d, v in enumerate(center)
        ]
        return spark.createDataFrame(rows, "cluster int, dim int, value double")


def scaled_vector(df: DataFrame, cols: Sequence[str], out: str = "features", scale: bool = True) -> DataFrame:
    """Columns, rescaled to [0, 1] unless told otherwise, as one array column next to the
    original ones."""
    if not scale:
        return df.withColumn(out, F.array(*[quoted(c).cast("double") for c in cols]))
    scaled = minmax_scale(df, cols, suffix="__unit")
    names = [c + "__unit" for c in cols]
    return scaled.withColumn(out, F.array(*[quoted(c) for c in names])).drop(*names)


def first_centers(df: DataFrame, vector: str, k: int, seed: int) -> np.ndarray:
    """k different rows of lowest hash.  A short top-n suffices unless copies of few rows crowd
    it; then the distinct rows are ranked."""
    ranked = df.select(F.col(vector).alias("v")).withColumn("h", hash_hex([_vector_text("v")], seed))
    seen: dict[tuple, None] = {}
    for r in ranked.orderBy("h").limit(8 * k).collect():
        seen.setdefault(tuple(r["v"]))
    if len(seen) < k:
        seen = {tuple(r["v"]): None for r in ranked.distinct().orderBy("h").limit(k).collect()}
    if len(seen) < k:
        raise ValueError(f"only {len(seen)} different rows for {k} clusters")
    return np.array(list(seen)[:k])


def _vector_text(name: str):
    """Text of a vector in millionths: the same digits in every engine."""

    def millionths(v):
        """Rounded half away from zero; ``round`` would take a decimal of every value."""
        size = F.abs(v * 1e6)
        whole = F.floor(size)
        whole = whole + (size - whole >= 0.5).cast("long")
        return F.when(v < 0, -whole).otherwise(whole).cast("string")

    return F.array_join(F.transform(name, millionths), ",")


def _draws(x: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) of every row, mixed from the bits of its values."""
    h = np.full(len(x), (seed * 0x9E3779B97F4A7C15 + 1) % 2**64, dtype=np.uint64)
    for column in np.ascontiguousarray((x + 0.0).T).view(np.uint64):
        h = (h ^ column) + np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return (h >> np.uint64(11)) * 2.0**-53


def _drawn(rows: DataFrame, centers: np.ndarray, wanted: float, seed: int) -> tuple[float, np.ndarray]:
    """The sum of the squared distances from the centers, and the different rows drawn with a
    chance of their part in it times ``wanted``; one reading.  A task knows the sum of its own
    rows so far, which is less: it keeps the rows that would be drawn by that, a handful, and the
    whole sum decides among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, held = 0.0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch, "v")
            gap = _assign_many(x, [centers])[0][1]
            cost += gap.sum()
            table = np.column_stack([gap, _draws(x, seed)])
            first = table[:, 1] * (cost * (1 - 1e-8)) <= wanted * gap
            fresh = np.column_stack([table[first], x[first]])
            held = np.unique(fresh if held is None else np.concatenate([held, fresh]), axis=0)
            held = held[held[:, 1] * (cost * (1 - 1e-8)) <= wanted * held[:, 0]]
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([cost]), pa.array([held.ravel()])], names=["cost", "held"])

    tasks = rows.mapInArrow(run, "cost double, held array<double>").collect()
    cost = math.fsum(r["cost"] for r in tasks)
    held = np.array([v for r in tasks for v in r["held"]], dtype=float).reshape(-1, centers.shape[1] + 2)
    if not cost:
        return 0.0, held[:0, 2:]
    # nine digits, so that the order of adding up does not show
    return cost, held[held[:, 1] < wanted / float(f"{cost:.8e}") * held[:, 0], 2:]


def oversampled_centers(df: DataFrame, vector: str, k: int, seed: int, rounds: int = 5, factor: float = 2.0) -> np.ndarray:
    """k start centers by oversampling (k-means||).

    Every round takes each different row with a chance in proportion to its squared distance from
    the centers so far, about ``factor * k`` rows; its draw is a hash of the row, so any
    partitioning takes the same.  The rows taken, weighted by how many rows they are nearest to,
    are reduced to k by weighted k-means++ and a few weighted updates."""
    rows = df.select(F.col(vector).alias("v"))
    taken = first_centers(df, vector, 1, seed)
    for i in range(rounds):
        cost, fresh = _drawn(rows, taken, factor * k, seed + i + 1)
        if not cost:
            break
        taken = np.unique(np.concatenate([taken, fresh]), axis=0)
    if len(taken) < k:
        return first_centers(df, vector, k, seed)

    @F.arrow_udf("int")
    def nearest(v: pa.Array) -> pa.Array:
        x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)
        return pa.array(_assign_many(x, [taken])[0][0].astype(np.int32))

    weight = np.zeros(len(taken))
    for r in rows.groupBy(nearest(F.col("v")).alias("c")).count().collect():
        weight[r["c"]] = r["count"]
    return _reduced(taken, weight, k, seed)


def _reduced(points: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k centers of weighted points: drawn by weighted k-means++, then a few weighted updates."""
    rng = np.random.default_rng(seed)
    chosen = [int(np.argmax(weight))]
    gap = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        mass = weight * gap
        if not mass.any():
            mass = np.isin(np.arange(len(points)), chosen, invert=True).astype(float)
        chosen.append(int(np.searchsorted(np.cumsum(mass), rng.random() * mass.sum(), side="right")))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    centers = points[chosen]
    for _ in range(10):
        which, _ = _assign(points, centers)
        mass = np.bincount(which, weight, k)
        sums = np.column_stack([np.bincount(which, weight * points[:, j], k) for j in range(points.shape[1])])
        centers = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-300)[:, None], centers)
    return centers


START = {"hashed": first_centers, "oversampled": oversampled_centers}


def kmeans_many(
    df: DataFrame, vector: str, ks: Sequence[int], seed: int = 25, max_iter: int = 10, centers: np.ndarray | None = None,
    start: str = "hashed",
) -> dict[int, KMeansFit]:
    """One fit per number of clusters, all in the same passes.  Without given centers they start
    at hashed rows, the same for all numbers, or each at ``oversampled`` ones."""
    vectors = df.select(F.col(vector).cast("array<double>").alias("x"))
    rows = keep_for_passes(vectors, with_task(vectors).agg(occupied_partitions()).first()[0])
    try:
        if centers is None and start == "oversampled":
            at = {k: oversampled_centers(rows.df, "x", k, seed) for k in ks}
        else:
            first = START[start](rows.df, "x", max(ks), seed) if centers is None else np.asarray(centers, dtype=float)
            at = {k: first[:k].copy() for k in ks}
        dim = next(iter(at.values())).shape[1]
        fits: dict[int, KMeansFit] = {}
        moving = set(ks)
        for iteration in range(max_iter + 1):
            now = {k: at[k] for k in moving}

            def kernel(batch, now=now):
                x = matrix(batch, "x")
                columns = np.ascontiguousarray(x.T)
                out = {}
                for k, (which, gap) in zip(now, _assign_many(x, list(now.values()))):
                    sums = np.column_stack([np.bincount(which, column, k) for column in columns])
                    out[k] = np.concatenate([np.bincount(which, minlength=k), sums.ravel(), [gap.sum()]])
                return out

            totals = summed(rows, kernel)
            for k in sorted(moving):
                flat = dense(totals, k, k * (dim + 1) + 1)
                size, sums = flat[:k], flat[k:-1].reshape(k, dim)
                # an empty cluster keeps its center
                moved = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], at[k])
                fits[k] = KMeansFit(k, vector, at[k], float(flat[-1]), iteration, size)
                if iteration == max_iter or np.allclose(moved, at[k], rtol=0, atol=1e-12):
                    moving.discard(k)
                at[k] = moved
            if not moving:
                break
        return fits
    finally:
        rows.release()


def kmeans(
    df: DataFrame, vector: str, k: int = 6, seed: int = 25, max_iter: int = 10, centers=None, start: str = "hashed"
) -> KMeansFit:
    """Centers after at most ``max_iter`` updates from k hashed or oversampled start rows (or given centers)."""
    return kmeans_many(df, vector, [k], seed, max_iter, centers, start)[k]


def elbow(df: DataFrame, vector: str, ks: Sequence[int] = tuple(range(1, 21)), seed: int = 25, max_iter: int = 10) -> DataFrame:
    """``(k, within_ss)``: total within-cluster sum of squares for every k."""
    fits = kmeans_many(df, vector, ks, seed, max_iter)
    return df.sparkSession.createDataFrame([(k, fits[k].within_ss) for k in sorted(fits)], "k int, within_ss double")
