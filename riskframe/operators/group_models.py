"""Ridge logistic models for very many groups, held as a table.

``linear.per_group_logit`` keeps a fit per group on the driver, which suits tens or hundreds of
them.  Here a fit is a row of a table.  Rows are laid out once, by group, and a task fits the
groups of a batch side by side to their end, all their steps in one reading.  Only groups of too
many rows for that are cut into parts: the Newton state of each is a row of a table too, a pass
brings the states to the rows, so that the rows stay where they are, and a group's partial sums,
at most one per task that holds it, to its state.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted
from riskframe.operators.design import design
from riskframe.operators.linear import LogitSet, _advance, _solve, _unpack
from riskframe.operators.partials import matrix, vector
from riskframe.sources.scratch import discard, materialize, recorded

ROWS_PER_PART = 50_000  # different rows of a group that one task may hold before it is cut
BLOCK = 2_000_000  # doubles of cross products that a task holds at a time


@dataclass
class GroupTable:
    """One row per group: rows, successes, coefficients (null where there is one class only),
    iterations, converged."""

    group: str
    x: list[str]
    models: DataFrame

    def to_df(self) -> DataFrame:
        """``(group, feature, importance)`` without intercepts; null where the group has one class."""
        pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col("coef")[i].alias("importance")) for i, n in enumerate(self.x, start=1)])
        return self.models.select(quoted(self.group), F.explode(pairs).alias("_pair")).select(quoted(self.group), "_pair.*")

    def score(self, df: DataFrame, out: str = "prob", threshold: float | None = None) -> DataFrame:
        """Probabilities by the row's own group model, null where there is none."""
        models = self.models.select(quoted(self.group), F.col("coef").alias("_coef"))
        eta = F.col("_coef")[0]
        for i, c in enumerate(self.x, start=1):
            eta = eta + F.col("_coef")[i] * quoted(c).cast("double")
        scored = df.join(models, self.group, "left").withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-eta)))
        if threshold is not None:
            scored = scored.withColumn("pred", (F.col(out) > F.lit(threshold)).cast("int"))
        return scored.drop("_coef")


def group_logit_table(
    df: DataFrame,
    group: str,
    y: str,
    x: Sequence[str],
    C: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-12,
    rows_per_part: int = ROWS_PER_PART,
) -> GroupTable:
    """A ridge logistic model for every group, as ``per_group_logit`` fits it, for any number of
    groups.  Rows with a null in the group, the label or a predictor take no part; a group without
    any other row has no entry.  Equal rows of a group count as one weighted row.  Columns are put
    on one scale for all groups, which only steers the numerics.  An empty table gives no models.
    """
    spark = df.sparkSession
    d = design(df, x)
    xs = [f"x{i}" for i in range(len(d.columns))]
    base = df.select(
        quoted(group).alias("g"), quoted(y).cast("double").alias("y"), *[c.cast("double").alias(n) for c, n in zip(d.columns, xs)]
    ).dropna()
    cells = base.groupBy("g", *xs).agg(F.sum("y").alias("s"), F.count("*").cast("double").alias("n"))
    with recorded() as folded:
        cells = materialize(cells, "group-cells")
    moments = cells.agg(
        F.count("*").alias("cells"),
        *[(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(f"m_{c}") for c in xs],
        *[F.stddev_pop(c).alias(f"sd_{c}") for c in xs],
    ).first()
    shift = np.array([moments[f"m_{c}"] or 0.0 for c in xs])
    scale = np.array([moments[f"sd_{c}"] or 1.0 for c in xs])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a task holds so many rows of a group while it fits it; without a ridge columns may fall out, step by step
    held = min(rows_per_part, BLOCK // (len(xs) + 2) ** 2) if math.isfinite(C) else 0
    per_part = max(rows_per_part, moments["cells"] // tasks)
    sizes = cells.groupBy("g").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("rows"))
    none = F.lit(None).cast("array<double>")
    with recorded() as written:
        state = materialize(
            sizes.where(F.col("rows") > held).select(
                "g", "n", "s", F.ceil(F.col("rows") / per_part).cast("int").alias("parts"), none.alias("beta"), none.alias("best"),
                F.lit(float("inf")).alias("objective"), F.lit(0).alias("iterations"), F.lit(False).alias("converged"),
                ((F.col("s") > 0) & (F.col("s") < F.col("n"))).alias("active"),
            ),
            "group-state",
        )
    # the groups of more than ``held`` rows: fewer than all rows hold that many
    large = F.broadcast(state.select("g", "parts"))
    values = F.array(*xs).alias("x")
    small = cells.join(large, "g", "left_anti").select("g", values, "s", "n").repartition(tasks, "g").sortWithinPartitions("g")
    small = materialize(_fitted(small, shift, scale, 1.0 / C, tol, max_iter), "group-models")
    part = F.pmod(F.xxhash64(*xs), F.col("parts").cast("long")).cast("int")
    rows = cells.join(large, "g").select("g", part.alias("part"), values, "s", "n")
    rows = rows.repartition(tasks, "g", "part").sortWithinPartitions("g", "part").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for step in range(max_iter + 12):
            if state.where("active").isEmpty():
                break
            with recorded() as paths:
                state = materialize(_step(rows, state, shift, scale, 1.0 / C, tol, max_iter, first=step == 0), "group-state")
            discard(spark, written)
            written = paths
    finally:
        rows.unpersist()
        discard(spark, folded)
    state = state.select(*small.columns).unionByName(small)
    raw = [F.col("best")[i + 1] / float(v) for i, v in enumerate(scale)]
    start = F.col("best")[0]
    for c, m in zip(raw, shift):
        start = start - c * float(m)
    coef = F.when(F.col("best").isNotNull(), F.array(start, *raw))
    models = state.select(F.col("g").alias(group), F.col("n").cast("long").alias("n"), F.col("s").alias("successes"), coef.alias("coef"), "iterations", "converged")
    return GroupTable(group, list(x), models)


def _fitted(rows: DataFrame, shift, scale, ridge: float, tol: float, max_iter: int) -> DataFrame:
    """The finished models of groups whose rows lie together: (g, n, s, best, iterations, converged)."""
    kind = rows.schema["g"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []  # pieces of the last group, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0)
            codes = key.dictionary_encode().indices.to_numpy()
            last = int(np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])[-1])
            if last or (waiting and waiting[-1].column(0)[0] != key[0]):
                # the last group begins in this batch: what lies before it is whole
                yield fit([*waiting, batch.slice(0, last)])
                waiting = []
            waiting.append(batch.slice(last))
        if waiting:
            yield fit(waiting)

    def fit(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(pieces).combine_chunks().to_batches()[0]
        key = whole.column(0)
        codes = key.dictionary_encode().indices.to_numpy()
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        x = np.hstack([np.ones((whole.num_rows, 1)), (matrix(whole, "x") - shift) / scale])
        s, n = vector(whole, "s"), vector(whole, "n")
        best, known, iterations, converged = _newton(x, s, n, starts, ridge, scale, tol, max_iter)
        offsets = pa.array(np.arange(len(starts) + 1, dtype=np.int32) * x.shape[1], mask=np.r_[~known, False])
        return pa.RecordBatch.from_arrays(
            [
                key.take(pa.array(starts)), pa.array(np.add.reduceat(n, starts)), pa.array(np.add.reduceat(s, starts)),
                pa.ListArray.from_arrays(offsets, pa.array(best.ravel())), pa.array(iterations), pa.array(converged),
            ],
            names=["g", "n", "s", "best", "iterations", "converged"],
        )

    return rows.mapInArrow(run, f"g {kind}, n double, s double, best array<double>, iterations int, converged boolean")


def _newton(x: np.ndarray, s: np.ndarray, n: np.ndarray, starts: np.ndarray, ridge: float, scale, tol: float, max_iter: int) -> tuple[np.ndarray, ...]:
    """The steps of ``linear._advance`` for all groups of the rows at once, until none moves:
    coefficients, whether there are any, steps, whether they came to rest."""
    count, p = len(starts), x.shape[1]
    upper = np.triu_indices(p)
    m = len(upper[0])
    penalty = np.r_[0.0, ridge / np.asarray(scale) ** 2]
    of = np.repeat(np.arange(count), np.diff(np.r_[starts, len(x)]))
    successes, total = np.add.reduceat(s, starts), np.add.reduceat(n, starts)
    active = (successes > 0) & (successes < total)
    beta, best = np.zeros((count, p)), np.zeros((count, p))
    known, converged = np.zeros(count, dtype=bool), np.zeros(count, dtype=bool)
    objective, iterations = np.full(count, math.inf), np.zeros(count, dtype=np.int32)
    for step in range(max_iter + 12):
        now = np.flatnonzero(active)
        if not len(now):
            break
        inside = active[of]
        if not inside.all():
            x, s, n, of = x[inside], s[inside], n[inside], of[inside]
        at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        sums = np.add.reduceat(_row_sums(x, s, n, beta[of] if step else None, upper), at, axis=0)
        h = np.zeros((len(now), p, p))
        h[:, upper[0], upper[1]] = h[:, upper[1], upper[0]] = sums[:, :m]
        h += np.diag(penalty)
        score, dev = sums[:, m : m + p], sums[:, -1]
        if not step:
            beta[now], objective[now], iterations[now] = _solved(h, score), dev, 1
            continue
        here = dev + (penalty * beta[now] ** 2).sum(axis=1)
        change = np.abs(here - objective[now]) / (np.abs(here) + 0.1)
        over = known[now] & (here > objective[now]) & (change > 1e-7) & (iterations[now] < max_iter)
        far = now[over]  # overshoot: halve the step and look again
        beta[far] = (beta[far] + best[far]) / 2
        near = now[~over]
        best[near], known[near], converged[near], objective[near] = beta[near], True, change[~over] < tol, here[~over]
        active[near] = ~converged[near] & (iterations[near] < max_iter)
        on = ~over & active[now]
        beta[now[on]] += _solved(h[on], score[on] - penalty * beta[now[on]])
        iterations[now[over | on]] += 1
    return best, known, iterations, converged


def _solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(a, b[:, :, None])[:, :, 0]
    except np.linalg.LinAlgError:
        return np.array([_solve(one, side) for one, side in zip(a, b)])


def _row_sums(x: np.ndarray, s: np.ndarray, n: np.ndarray, beta: np.ndarray | None, upper: tuple) -> np.ndarray:
    """What every row adds to X'WX (upper triangle), score and deviance of its group."""
    if beta is None:
        # response start: fitted probability 3/4 for y=1 and 1/4 for y=0
        w, dev = n * (3 / 16), -2 * n * math.log(0.75)
        rest = (2 * s - n) * (3 / 16) * (math.log(3) + 4 / 3)
    else:
        eta = (x * beta).sum(axis=1)
        p = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
        dev = 2 * (s * np.logaddexp(0, -eta) + (n - s) * np.logaddexp(0, eta))
        w, rest = n * p * (1 - p), s - n * p
    return np.hstack([x[:, upper[0]] * x[:, upper[1]] * w[:, None], x * rest[:, None], dev[:, None]])


def _step(rows: DataFrame, state: DataFrame, shift, scale, ridge: float, tol: float, max_iter: int, first: bool) -> DataFrame:
    """The state after one more Newton step of all groups that still move."""
    kind = state.schema["g"].dataType.simpleString()
    moving = state.where("active")
    there = moving.select("g", "beta", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    met = rows.join(there, ["g", "part"]).select("g", "x", "s", "n", "beta")
    p = len(shift) + 1
    upper = np.triu_indices(p)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last group of a batch may go on in the next one
        for batch in batches:
            for at in range(0, batch.num_rows, max(1, BLOCK // len(upper[0]))):
                piece = batch.slice(at, max(1, BLOCK // len(upper[0])))
                x = np.hstack([np.ones((piece.num_rows, 1)), (matrix(piece, "x") - shift) / scale])
                beta = None if first else matrix(piece, "beta")
                per_row = _row_sums(x, vector(piece, "s"), vector(piece, "n"), beta, upper)
                key = piece.column(0)
                codes = key.dictionary_encode().indices.to_numpy()
                starts = np.r_[0, np.flatnonzero(codes[1:] != codes[:-1]) + 1]
                total, key = np.add.reduceat(per_row, starts, axis=0), key.take(pa.array(starts))
                if held is not None:
                    if held[0][0] == key[0]:
                        total[0] += held[1][0]
                    else:
                        total, key = np.vstack([held[1], total]), pa.concat_arrays([held[0], key])
                held = key.slice(len(key) - 1), total[-1:]
                if len(key) > 1:
                    yield listed(key.slice(0, len(key) - 1), total[:-1])
        if held is not None:
            yield listed(*held)

    def listed(key: pa.Array, total: np.ndarray) -> pa.RecordBatch:
        offsets = pa.array(np.arange(len(key) + 1, dtype=np.int32) * total.shape[1])
        return pa.RecordBatch.from_arrays([key, pa.ListArray.from_arrays(offsets, pa.array(np.ravel(total)))], names=["g", "sums"])

    def advanced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every group's state row comes first, then its partial sums."""
        row, total = None, None

        def moved() -> dict:
            s = LogitSet(list(range(p - 1)), ridge=ridge, objective=row["objective"], iterations=row["iterations"])
            s.beta, s.best = (None if row[c] is None else np.array(row[c]) for c in ("beta", "best"))
            _advance(s, *_unpack(total, p), scale, tol, max_iter)
            return row | {
                "beta": s.beta.tolist(), "best": None if s.best is None else s.best.tolist(), "objective": float(s.objective),
                "iterations": s.iterations, "converged": bool(s.converged), "active": s.active,
            }

        for batch in batches:
            done = []
            partial = batch.column(batch.schema.get_field_index("sums"))
            whole = batch.drop_columns(["sums"]).to_pylist()
            for i, r in enumerate(whole):
                if r["parts"] is not None:
                    if row is not None:
                        done.append(moved())
                    row, total = r, np.zeros(len(upper[0]) + p + 1)
                else:
                    total = total + partial[i].values.to_numpy()
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=batch.drop_columns(["sums"]).schema)
        if row is not None:
            yield pa.RecordBatch.from_pylist([moved()], schema=batch.drop_columns(["sums"]).schema)

    partials = met.mapInArrow(sums, f"g {kind}, sums array<double>")
    both = moving.unionByName(partials, allowMissingColumns=True)
    ahead = both.repartition("g").sortWithinPartitions("g", F.col("parts").isNull())
    return ahead.mapInArrow(advanced, state.schema).unionByName(state.where("not active"))
