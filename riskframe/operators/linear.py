"""Least squares, logistic GLM, ridge logistic and per-group logistic models.

All logistic fits share one Newton loop.  A pass over the cached design returns, for every
coefficient set still being fitted, X'WX, the score and the deviance; the driver solves the
small systems.  Candidates of a search and groups of a segmentation are just more sets in
the same pass."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted
from riskframe.operators.design import Design, design
from riskframe.operators.partials import dense, matrix, summed, vector
from riskframe.operators.placement import Kept, keep_folded, keep_for_passes, occupied_partitions, with_task

INTERCEPT = "(Intercept)"
PASS_BUDGET = 2_000_000  # doubles of partial sums per task and pass


# ---- rows of a fit ---------------------------------------------------------------------


@dataclass
class FitRows:
    """Cached rows ``(x array<double>, s, n[, g])``: s successes in n equal observations."""

    kept: Kept
    shift: np.ndarray
    scale: np.ndarray
    n: float
    successes: float
    grouped: bool = False

    def release(self) -> None:
        self.kept.release()


def fit_rows(df: DataFrame, y: str, columns: Sequence[Column], group: str | None = None, fold: bool = True) -> FitRows:
    """Complete rows of y and the design columns, with the means and spreads that put the
    passes on a common scale.  When the design repeats itself at least fourfold (all-discrete
    predictors), equal rows are folded into one row with counts, which leaves the likelihood
    unchanged; the test is a sketch in the same job as the means."""
    named = [c.alias(f"x{i}") for i, c in enumerate(columns)]
    base = df.select(quoted(y).cast("double").alias("y"), *named, *([quoted(group).alias("g")] if group else []))
    base = base.dropna()
    xs = [f"x{i}" for i in range(len(columns))]
    stats = with_task(base).agg(
        F.count("*").alias("n"),
        F.sum("y").alias("s"),
        F.approx_count_distinct(F.xxhash64(*base.columns)).alias("d"),
        occupied_partitions().alias("occupied"),
        *[F.avg(x).alias(f"m_{x}") for x in xs],
        *[F.stddev_pop(x).alias(f"sd_{x}") for x in xs],
    ).first()
    if not stats["n"]:
        raise ValueError("no complete rows to fit")
    shift = np.array([stats[f"m_{x}"] for x in xs])
    scale = np.array([stats[f"sd_{x}"] or 1.0 for x in xs])
    extra = ["g"] if group else []
    fold = fold and stats["d"] * 4 <= stats["n"]
    if fold:
        base = base.groupBy(*xs, *extra).agg(F.sum("y").alias("s"), F.count("*").cast("double").alias("n"))
    else:
        base = base.withColumns({"s": F.col("y"), "n": F.lit(1.0)})
    packed = base.select(F.array(*xs).alias("x"), "s", "n", *extra)
    kept = keep_folded(packed, stats["d"]) if fold else keep_for_passes(packed, stats["occupied"])
    return FitRows(kept, shift, scale, stats["n"], stats["s"], group is not None)


# ---- the Newton loop -------------------------------------------------------------------


@dataclass
class LogitSet:
    """One model of a batch: design positions, group value, ridge strength, start vector."""

    cols: list[int]
    group: object = None
    ridge: float = 0.0
    start: np.ndarray | None = None  # standardised scale; None = start from the responses
    # state
    beta: np.ndarray | None = None
    best: np.ndarray | None = None
    hessian: np.ndarray | None = None
    objective: float = math.inf
    deviance: float = math.inf
    iterations: int = 0
    converged: bool = False
    active: bool = True


def _unpack(flat: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray, float]:
    m = p * (p + 1) // 2
    h = np.zeros((p, p))
    h[np.triu_indices(p)] = flat[:m]
    return h + np.triu(h, 1).T, flat[m : m + p], float(flat[-1])


def independent(h: np.ndarray, tol: float = 1e-9) -> list[int]:
    """Positions, in order, of the columns that do not depend on earlier ones (elimination on
    the cross-product matrix; a pivot that shrinks by ``tol`` marks a dependent column)."""
    a, keep = h.copy(), []
    scale = np.maximum(np.diag(h), 1e-300)
    for j in range(len(a)):
        if a[j, j] > tol * scale[j]:
            keep.append(j)
            a = a - np.outer(a[:, j], a[j, :]) / a[j, j]
    return keep


def _pass(rows: FitRows, sets: Mapping[int, LogitSet]) -> dict[int, tuple]:
    """X'WX, score and deviance of each set at its current coefficients."""
    shift, scale, grouped = rows.shift, rows.scale, rows.grouped
    plan = {k: (np.array([0, *[c + 1 for c in s.cols]]), s.beta, s.group) for k, s in sets.items()}

    def one(x, s, n, beta):
        if beta is None:
            # response start: fitted probability 3/4 for y=1 and 1/4 for y=0
            w, dev = n * (3 / 16), -2 * n.sum() * math.log(0.75)
            score = x.T @ ((2 * s - n) * (3 / 16) * (math.log(3) + 4 / 3))
        else:
            eta = x @ beta
            p = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
            dev = 2 * (s @ np.logaddexp(0, -eta) + (n - s) @ np.logaddexp(0, eta))
            w, score = n * p * (1 - p), x.T @ (s - n * p)
        h = x.T @ (x * w[:, None])
        return np.concatenate([h[np.triu_indices(len(h))], score, [dev]])

    def kernel(batch):
        x = (matrix(batch, "x") - shift) / scale
        x = np.hstack([np.ones((len(x), 1)), x])
        s, n = vector(batch, "s"), vector(batch, "n")
        if not grouped:
            return {k: one(x[:, cols], s, n, beta) for k, (cols, beta, _) in plan.items()}
        coded = batch.column(batch.schema.get_field_index("g")).dictionary_encode()
        code_of = {v: i for i, v in enumerate(coded.dictionary.to_pylist())}
        codes = coded.indices.to_numpy()
        out = {}
        for k, (cols, beta, group) in plan.items():
            if group in code_of:
                hit = codes == code_of[group]
                out[k] = one(x[hit][:, cols], s[hit], n[hit], beta)
        return out

    totals = summed(rows.kept, kernel)
    sizes = {k: len(s.cols) + 1 for k, s in sets.items()}
    return {k: _unpack(dense(totals, k, p * (p + 1) // 2 + p + 1), p) for k, p in sizes.items()}


def _chunks(sets: Mapping[int, LogitSet]):
    """Split a pass so that no task holds more than the budget of partial sums."""
    chunk, used = {}, 0
    for k, s in sets.items():
        p = len(s.cols) + 1
        if chunk and used + p * p > PASS_BUDGET:
            yield chunk
            chunk, used = {}, 0
        chunk[k], used = s, used + p * p
    if chunk:
        yield chunk


def fit_logits(rows: FitRows, sets: Sequence[LogitSet], tol: float = 1e-8, max_iter: int = 25) -> list[LogitSet]:
    """Fit all sets; each stops by itself when its objective changes by less than ``tol``."""
    for s in sets:
        s.beta = s.start
    for _ in range(max_iter + 12):
        active = {i: s for i, s in enumerate(sets) if s.active}
        if not active:
            break
        for chunk in _chunks(active):
            for i, (h, score, dev) in _pass(rows, chunk).items():
                _advance(sets[i], h, score, dev, rows.scale, tol, max_iter)
    return list(sets)


def _advance(s: LogitSet, h, score, dev, scale, tol: float, max_iter: int) -> None:
    penalty = np.r_[0.0, s.ridge / scale[s.cols] ** 2]
    if s.beta is None:
        keep = independent(h) if not s.ridge else list(range(len(h)))
        if len(keep) < len(h):
            s.cols = [s.cols[j - 1] for j in keep if j]
            h, score, penalty = h[np.ix_(keep, keep)], score[keep], penalty[keep]
        s.beta = _solve(h + np.diag(penalty), score)
        s.objective, s.iterations = dev, 1
        return
    objective = dev + float(penalty @ s.beta**2)
    change = abs(objective - s.objective) / (abs(objective) + 0.1)
    if s.best is not None and objective > s.objective and change > 1e-7 and s.iterations < max_iter:
        s.beta = (s.beta + s.best) / 2  # overshoot: halve the step and look again
        s.iterations += 1
        return
    s.hessian, s.deviance, s.best = h + np.diag(penalty), dev, s.beta
    s.converged = change < tol
    s.objective = objective
    if s.converged or s.iterations >= max_iter:
        s.active = False
        return
    s.beta = s.beta + _solve(s.hessian, score - penalty * s.beta)
    s.iterations += 1


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(a, b, rcond=None)[0]


def _unscale(cols: Sequence[int], shift, scale) -> np.ndarray:
    """Linear map from coefficients on the standardised scale to those of the raw columns."""
    t = np.diag(np.r_[1.0, 1 / scale[cols]])
    t[0, 1:] = -shift[cols] / scale[cols]
    return t


# ---- fitted objects --------------------------------------------------------------------


@dataclass
class LinearFit:
    """Coefficients over named design columns, intercept first; aliased columns are null."""

    names: list[str]
    coef: list[float | None]
    se: list[float | None]
    columns: list[Column] = field(repr=False)
    stats: dict = field(default_factory=dict)

    def rows(self) -> list[tuple]:
        out = []
        for name, b, se in zip(self.names, self.coef, self.se):
            b, se = (None if v is None else float(v) for v in (b, se))
            z = b / se if b is not None and se else None
            p = math.erfc(abs(z) / math.sqrt(2)) if z is not None else None
            out.append((name, b, se, z, p))
        return out

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.rows(), "name string, estimate double, std_error double, z_value double, p_value double"
        )

    def stats_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(k, float(v)) for k, v in self.stats.items()], "stat string, value double"
        )

    def linear_predictor(self) -> Column:
        eta = F.lit(float(self.coef[0]))
        for c, b in zip(self.columns, self.coef[1:]):
            if b is not None:
                eta = eta + F.lit(float(b)) * c
        return eta

    def score(self, df: DataFrame, out: str = "prob") -> DataFrame:
        """Probability column; a plain expression, so scoring is one fused projection."""
        return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-self.linear_predictor())))

    def importance(self, spark: SparkSession) -> DataFrame:
        """Coefficients without the intercept, largest first."""
        rows = [(n, b) for n, b in zip(self.names[1:], self.coef[1:]) if b is not None]
        frame = spark.createDataFrame(rows, "feature string, importance double")
        return frame.orderBy(F.col("importance").desc(), "feature")


def finish(rows: FitRows, s: LogitSet, d: Design) -> LinearFit:
    """Raw-scale coefficients, standard errors and fit statistics of a fitted set."""
    t = _unscale(s.cols, rows.shift, rows.scale)
    beta = t @ s.best
    cov = t @ np.linalg.pinv(s.hessian) @ t.T
    place = {c: i for i, c in enumerate([-1, *s.cols])}
    pick = [place.get(i) for i in range(-1, len(d.names))]
    coef = [None if i is None else float(beta[i]) for i in pick]
    se = [None if i is None else math.sqrt(max(cov[i, i], 0.0)) for i in pick]
    rate, p = rows.successes / rows.n, len(s.cols) + 1
    null_dev = 0.0
    for k in (rate, 1 - rate):
        null_dev -= 2 * rows.n * k * math.log(k) if k > 0 else 0.0
    stats = {
        "null_deviance": null_dev,
        "df_null": rows.n - 1,
        "deviance": s.deviance,
        "df_residual": rows.n - p,
        "aic": s.deviance + 2 * p,
        "iterations": s.iterations,
        "converged": float(s.converged),
    }
    return LinearFit([INTERCEPT, *d.names], coef, se, d.columns, stats)


# ---- operators -------------------------------------------------------------------------


def glm_logit(
    df: DataFrame, y: str, terms: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None,
    tol: float = 1e-8, max_iter: int = 25,
) -> LinearFit:
    """Maximum-likelihood logistic model with the usual summary."""
    d = design(df, terms, levels)
    rows = fit_rows(df, y, d.columns)
    try:
        (s,) = fit_logits(rows, [LogitSet(list(range(len(d.names))))], tol, max_iter)
        return finish(rows, s, d)
    finally:
        rows.release()


def ridge_logit(
    df: DataFrame, y: str, x: Sequence[str], C: float = 1.0, max_iter: int = 1000, tol: float = 1e-12
) -> LinearFit:
    """L2 logistic model: C times the log loss plus half the squared coefficients, intercept
    not penalised, columns not standardised."""
    d = design(df, x)
    rows = fit_rows(df, y, d.columns)
    try:
        (s,) = fit_logits(rows, [LogitSet(list(range(len(x))), ridge=1.0 / C)], tol, max_iter)
        return finish(rows, s, d)
    finally:
        rows.release()


def significant_terms(coefs: DataFrame, alpha: float = 0.1) -> DataFrame:
    """Coefficient rows with p at most alpha, intercept left out."""
    return coefs.filter((F.col("p_value") <= alpha) & (F.col("name") != INTERCEPT))


def select_significant(dummies: DataFrame, names: Sequence[str], y: str) -> DataFrame:
    return dummies.select(*[quoted(n) for n in names], quoted(y))


@dataclass
class GroupFits:
    """One ridge logistic model per group; groups with a single class carry no model."""

    group: str
    x: list[str]
    fits: dict  # group value -> LinearFit or None
    group_type: str

    def to_df(self, spark: SparkSession) -> DataFrame:
        """``(group, feature, importance)`` without intercepts; null where the group has one class."""
        rows = []
        for g, fit in self.fits.items():
            values = [None] * len(self.x) if fit is None else fit.coef[1:]
            rows.extend((g, n, v) for n, v in zip(self.x, values))
        return spark.createDataFrame(rows, f"`{self.group}` {self.group_type}, feature string, importance double")

    def score(self, df: DataFrame, out: str = "prob", threshold: float | None = None) -> DataFrame:
        """In-sample probabilities by the row's own group model, null where there is none."""
        coefs = df.sparkSession.createDataFrame(
            [(g, None if f is None else [float(b) for b in f.coef]) for g, f in self.fits.items()],
            f"`{self.group}` {self.group_type}, _coef array<double>",
        )
        b = F.col("_coef")
        eta = b[0]
        for i, c in enumerate(self.x, start=1):
            eta = eta + b[i] * quoted(c).cast("double")
        scored = df.join(coefs, self.group, "left").withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-eta)))
        if threshold is not None:
            scored = scored.withColumn("pred", (F.col(out) > F.lit(threshold)).cast("int"))
        return scored.drop("_coef")


def per_group_logit(
    df: DataFrame, group: str, y: str, x: Sequence[str], C: float = 1.0, max_iter: int = 1000, tol: float = 1e-12
) -> GroupFits:
    """A ridge logistic model for every group, all of them in the same passes; a group may be
    of any size because it is never gathered in one place."""
    d = design(df, x)
    kind = dict(df.dtypes)[group]
    rows = fit_rows(df, y, d.columns, group)
    try:
        both = rows.kept.df.groupBy("g").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
        groups = sorted(r["g"] for r in both)
        fitted = sorted(r["g"] for r in both if 0 < r["s"] < r["n"])
        sets = [LogitSet(list(range(len(x))), group=g, ridge=1.0 / C) for g in fitted]
        done = dict(zip(fitted, fit_logits(rows, sets, tol, max_iter)))
        fits = {g: finish(rows, done[g], d) if g in done else None for g in groups}
        return GroupFits(group, list(x), fits, kind)
    finally:
        rows.release()


def importance_matrix(coefs: DataFrame, group: str, groups: Sequence, prefix: str = "cluster_") -> DataFrame:
    """Feature by group: one column ``<prefix><group>`` per group."""
    wide = coefs.groupBy("feature").pivot(group, list(groups)).agg(F.first("importance"))
    return wide.withColumnsRenamed({str(g): f"{prefix}{g}" for g in groups})


# ---- least squares ---------------------------------------------------------------------


def cross_products(df: DataFrame, y: str, d: Design) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Centred and scaled cross products of (x, y), with shift, scale and row count."""
    named = [c.alias(f"x{i}") for i, c in enumerate([*d.columns, quoted(y).cast("double")])]
    base = df.select(*named).dropna()
    xs = base.columns
    stats = with_task(base).agg(
        F.count("*").alias("n"), occupied_partitions().alias("occupied"), *[F.avg(x).alias(f"m_{x}") for x in xs], *[F.stddev_pop(x).alias(f"sd_{x}") for x in xs]
    ).first()
    shift = np.array([stats[f"m_{x}"] for x in xs])
    scale = np.array([stats[f"sd_{x}"] or 1.0 for x in xs])

    def kernel(batch):
        x = (matrix(batch, "x") - shift) / scale
        return {0: (x.T @ x).ravel()}

    p = len(xs)
    once = Kept(base.select(F.array(*xs).alias("x")), 2 * stats["occupied"])  # a single pass: nothing to persist
    gram = dense(summed(once, kernel), 0, p * p).reshape(p, p)
    return gram, shift, scale, float(stats["n"])


def ols(df: DataFrame, y: str, terms: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None) -> LinearFit:
    """Least squares on a mixed design from one pass of cross products."""
    d = design(df, terms, levels)
    gram, shift, scale, n = cross_products(df, y, d)
    keep = independent(gram[:-1, :-1])
    a, b = gram[np.ix_(keep, keep)], gram[keep, -1]
    beta = _solve(a, b)
    rss = max(gram[-1, -1] - beta @ b, 0.0) * scale[-1] ** 2
    p = len(keep) + 1
    sigma2 = rss / (n - p) if n > p else float("nan")
    inv = np.linalg.inv(a) * sigma2
    slope = beta * scale[-1] / scale[keep]
    part = shift[keep] / scale[keep]
    coef: list[float | None] = [None] * len(d.names)
    se: list[float | None] = [None] * len(d.names)
    for i, j in enumerate(keep):
        coef[j], se[j] = float(slope[i]), math.sqrt(inv[i, i]) / scale[j]
    intercept = float(shift[-1] - slope @ shift[keep])
    se0 = math.sqrt(sigma2 / n + part @ inv @ part)
    tss = gram[-1, -1] * scale[-1] ** 2
    stats = {"rss": rss, "df_residual": n - p, "sigma": math.sqrt(sigma2), "r_squared": 1 - rss / tss if tss else 0.0}
    return LinearFit([INTERCEPT, *d.names], [intercept, *coef], [se0, *se], d.columns, stats)


def gvif(df: DataFrame, y: str, terms: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``(term, gvif, df, gvif_scaled)`` of the design of ``y ~ terms``; rows incomplete in y
    are left out as in the fit.  gvif = det(R11) det(R22) / det(R) on design correlations."""
    d = design(df, terms, levels)
    gram, _, _, n = cross_products(df, y, d)
    r = gram[:-1, :-1] / n
    if len(independent(r)) < len(r):
        raise ValueError("the design has aliased columns, variance inflation is undefined")

    def logdet(i):
        return np.linalg.slogdet(r[np.ix_(i, i)])[1] if len(i) else 0.0

    everything = list(range(len(r)))
    rows = []
    for t in d.terms:
        own = d.positions([t])
        rest = [i for i in everything if i not in set(own)]
        value = math.exp(logdet(own) + logdet(rest) - logdet(everything))
        rows.append((t, value, len(own), value ** (1 / (2 * len(own)))))
    return df.sparkSession.createDataFrame(rows, "term string, gvif double, df int, gvif_scaled double")
