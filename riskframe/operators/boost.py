"""Boosted trees: Newton boosting with logistic loss, and AdaBoost (SAMME.R and SAMME).

Both keep one margin per row and model.  The margin fixes gradients or weights, so a round
needs no row updates: passes add the recent trees to the margin stored in the table, and the
table is written anew every few rounds.  Models of a parameter sweep share all passes."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.columns import quoted
from riskframe.operators.intervals import PIECES, Intervals, SplitSearch, found, interval_sums, merged, stats
from riskframe.operators.partials import dense, summed, vector
from riskframe.operators.placement import Kept, keep_folded, keep_for_passes, occupied_partitions, with_task
from riskframe.operators.trees import (
    Cuts,
    GiniRule,
    Grower,
    NewtonRule,
    Tree,
    TIE,
    ExactCuts,
    binned,
    byte_column,
    byte_matrix,
    feature_array,
    find_cuts,
    scan_features,
)
from riskframe.sources.scratch import materialize

REFRESH = 8  # rounds between two writes of the margins
PASS_BUDGET = 4_000_000  # doubles of partial histograms per task and pass
INTERVAL_BUDGET = 1_000_000  # intervals per task and pass
HELD_BUDGET = 32_000_000  # doubles of histograms that the driver keeps for the next level
SWEEP_WIDTH = 32  # models trained side by side
HELD_ROWS = 50_000  # folded rows beside which the points of a sweep are dealt out instead


# ---- models ----------------------------------------------------------------------------


@dataclass
class Booster:
    """A fitted or growing ensemble.  ``kind``: newton, samme.r, samme or tree."""

    kind: str
    cuts: Cuts
    params: dict
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    log_total: float = 0.0
    stopped: bool = False

    def rule(self):
        if self.kind == "newton":
            return NewtonRule(self.params["reg_lambda"], self.params["min_child_weight"], self.params["eta"])
        return GiniRule()

    def channels(self, y: np.ndarray, n: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.kind == "newton":
            p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            return n * (p - y), n * p * (1 - p)
        rate = self.params["learning_rate"] if self.kind == "samme.r" else 0.5
        w = n * np.exp(-rate * (2 * y - 1) * margin - self.log_total)
        return np.where(y == 0, w, 0.0), np.where(y == 1, w, 0.0)

    def accept(self, grower: Grower) -> None:
        """Take the finished tree of a round, or stop as the boosting variant demands."""
        tree = grower.tree()
        if self.kind != "newton":
            leaves = grower.leaf_nodes()
            total = sum(n.sums.sum() for n in leaves)
            tree.error = float(sum(n.sums.min() for n in leaves) / total)
            if self.kind == "samme":
                if tree.error >= 0.5:
                    if not self.trees:
                        raise ValueError("the first weak learner is no better than chance")
                    self.stopped = True
                    return
                rate = self.params["learning_rate"]
                tree.weight = 1.0 if tree.error <= 0 else rate * math.log((1 - tree.error) / tree.error)
                tree.value = np.where(tree.value > 0, 1.0, -1.0) * tree.weight
            self.stopped = tree.error <= 0 or self.kind == "tree"
            self.log_total += math.log(total)
        self.trees.append(tree)

    def margin(self, bins: np.ndarray, start: np.ndarray | float, first: int = 0) -> np.ndarray:
        out = np.full(len(bins), start, dtype=float) if np.isscalar(start) else start.copy()
        for tree in self.trees[first:]:
            out += tree.value[tree.route(bins)]
        return out

    def decision_scale(self) -> float:
        """Factor from the margin to the decision value whose sigmoid is the probability."""
        if self.kind == "samme.r":
            return 2.0 / max(len(self.trees), 1)
        if self.kind == "samme":
            return 1.0 / max(sum(t.weight for t in self.trees), 1e-300)
        return 2.0 if self.kind == "tree" else 1.0

    # ---- use of the fitted ensemble

    def predict(self, df: DataFrame, pred: str = "pred", prob: str = "prob", margin: str | None = None) -> DataFrame:
        """Add predicted class and probability (and the raw margin when named)."""
        model = self

        @F.arrow_udf("double")
        def score(x: pa.Array) -> pa.Array:
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            return pa.array(model.margin(model.cuts.bin(rows), model.base))

        raw = df.withColumn("_margin", score(feature_array(self.cuts.features)))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-self.decision_scale()) * F.col("_margin")))
        out = raw.withColumns({prob: p, pred: (F.col("_margin") > 0).cast("int")})
        return out.withColumnRenamed("_margin", margin) if margin else out.drop("_margin")

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The tree table: one row per node, thresholds in raw units, leaves without feature."""
        rows = []
        for t, tree in enumerate(self.trees, start=1):
            for i in range(len(tree.feature)):
                f = int(tree.feature[i])
                inner = f >= 0
                rows.append((
                    t, i, self.cuts.features[f] if inner else None,
                    self.cuts.threshold(f, int(tree.cut[i])) if inner else None,
                    int(tree.left[i]) if inner else None, int(tree.right[i]) if inner else None,
                    None if inner else float(tree.value[i]), float(tree.cover[i]), float(tree.gain[i]),
                ))
        return spark.createDataFrame(
            rows,
            "tree int, node int, feature string, threshold double, left int, right int, "
            "leaf_value double, cover double, gain double",
        )

    def rounds_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t.error, t.weight) for i, t in enumerate(self.trees, start=1)]
        return spark.createDataFrame(rows, "round int, error double, weight double")


def tree_importance(model: Booster, spark: SparkSession) -> DataFrame:
    """Impurity importance per feature: gains per tree scaled to one, averaged over the trees
    by weight, scaled to one again; largest first."""
    nodes = model.to_df(spark)
    weights = spark.createDataFrame([(i, t.weight) for i, t in enumerate(model.trees, start=1)], "tree int, w double")
    per_tree = nodes.groupBy("tree").agg(F.sum("gain").alias("total"))
    shares = (
        nodes.filter(F.col("feature").isNotNull())
        .join(per_tree, "tree")
        .join(weights, "tree")
        .groupBy("feature")
        .agg(F.sum(F.col("w") * F.try_divide("gain", "total")).alias("score"))
    )
    features = spark.createDataFrame([(f,) for f in model.cuts.features], "feature string")
    scored = features.join(shares, "feature", "left").select("feature", F.coalesce("score", F.lit(0.0)).alias("score"))
    whole = scored.agg(F.sum("score")).first()[0] or 1.0
    return scored.select("feature", (F.col("score") / whole).alias("importance")).orderBy(
        F.col("importance").desc(), "feature"
    )


# ---- training --------------------------------------------------------------------------


@dataclass
class BoostRows:
    """Binned training rows ``(bins, y, n[, margins])`` shared by a batch of models."""

    kept: Kept
    cuts: Cuts | ExactCuts
    written: int = 0  # trees per model already inside the margins column
    refresh = 0  # rounds between two writes of the margins; 0 takes REFRESH

    def release(self) -> None:
        self.kept.release()

    def sums(self, kernel) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        return summed(self.kept, kernel)

    def intervals(self, kernel) -> dict[int, Intervals]:
        return interval_sums(self.kept, kernel)

    def rewritten(self, run: Callable, written: int) -> BoostRows:
        new = materialize(self.kept.df.mapInArrow(run, "bins binary, y double, n double, margins binary"), "margins")
        return BoostRows(Kept(new.persist(StorageLevel.MEMORY_AND_DISK), self.kept.tasks), self.cuts, written)


@dataclass
class HeldRows:
    """The same, few enough to lie in one task: a folded table beside which models are many."""

    batch: pa.RecordBatch
    cuts: Cuts | ExactCuts
    written: int = 0
    refresh = 1

    def release(self) -> None:
        pass

    def sums(self, kernel) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        return {slot: (np.arange(len(v)), v) for slot, v in kernel(self.batch).items()}

    def intervals(self, kernel) -> dict[int, Intervals]:
        return {slot: found(part) for slot, part in kernel(self.batch).items()}

    def rewritten(self, run: Callable, written: int) -> HeldRows:
        return HeldRows(next(run(iter([self.batch]))), self.cuts, written)


def boost_rows(df: DataFrame, y: str, x: Sequence[str], max_bins: int, at: str) -> BoostRows:
    scan = scan_features(df, x, max_bins)
    cuts = find_cuts(df, scan, max_bins, at)
    fold = scan.folded(cuts)
    rows = binned(df, y, cuts, fold is not None, scan.fold is not None)
    return BoostRows(keep_for_passes(rows, scan.occupied) if fold is None else keep_folded(rows, fold), cuts)


def _margin_reader(models: Sequence[Booster], written: int, width: int, dtype) -> Callable:
    """Function from a batch to (bins, list of margins), margins including the recent trees."""
    n_models = len(models)

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
        bins = byte_matrix(batch, "bins", width, dtype)
        if written:
            stored = byte_matrix(batch, "margins", n_models, np.dtype(float))
            return bins, [m.margin(bins, stored[:, i], written) for i, m in enumerate(models)]
        return bins, [m.margin(bins, m.base) for m in models]

    return read


def _histograms(rows: BoostRows, models: Sequence[Booster], growers: dict[int, Grower], asked: list[tuple[int, int]]):
    """Histograms of the asked (model, node) pairs, one pass per budget-sized portion."""
    cuts = rows.cuts
    width, n_bins = len(cuts.features), cuts.n_bins
    size = width * n_bins * 2
    portion = max(1, PASS_BUDGET // size)
    for start in range(0, len(asked), portion):
        part = asked[start : start + portion]
        slots: dict[int, dict[int, int]] = {}
        for slot, (m, node) in enumerate(part):
            slots.setdefault(m, {})[node] = slot
        plans = {}
        for m, want in slots.items():
            tree, order = growers[m].routing()
            plans[m] = (tree, np.array([want.get(int(i), -1) for i in order]))
        used = {m: models[m] for m in plans}
        read = _margin_reader(models, rows.written, width, cuts.dtype)

        def kernel(batch, plans=plans, used=used, read=read):
            bins, margins = read(batch)
            y, n = vector(batch, "y"), vector(batch, "n")
            out = {}
            for m, (tree, slot_of) in plans.items():
                a, b = used[m].channels(y, n, margins[m])
                slot = slot_of[tree.route(bins)]
                hit = slot >= 0
                hs, ha, hb, hbins = slot[hit], a[hit], b[hit], bins[hit]
                ids = np.unique(slot_of[slot_of >= 0])
                local = np.zeros(ids.max() + 1, dtype=np.int64)
                local[ids] = np.arange(len(ids))
                row = local[hs] * n_bins
                hist = np.empty((len(ids), width, n_bins, 2))
                for f in range(width):
                    cell = row + hbins[:, f]
                    for channel, weight in enumerate((ha, hb)):
                        hist[:, f, :, channel] = np.bincount(cell, weight, len(ids) * n_bins).reshape(-1, n_bins)
                for k, s in enumerate(ids):
                    out[int(s)] = hist[k].ravel()
            return out

        totals = rows.sums(kernel)
        for slot, key in enumerate(part):
            yield key, dense(totals, slot, size).reshape(width, n_bins, 2)


def _split_searches(rows: BoostRows | HeldRows, models: Sequence[Booster], growers: dict[int, Grower], asked: list[tuple[int, int]]):
    """The finished split searches of the asked (model, node) pairs.  A pass reads, for all of
    them together, the intervals that are not settled yet."""
    cuts = rows.cuts
    width = len(cuts.features)
    routes = {m: growers[m].routing() for m, _ in asked}
    used = {m: models[m] for m in routes}
    read = _margin_reader(models, rows.written, width, cuts.dtype)
    known: dict[tuple[int, int], list[Intervals | None]] = {key: [None] * width for key in asked}
    parted: dict[tuple, np.ndarray] = {}
    open_ends = {(key, f): cuts.starts[f] for key in asked for f in range(width)}
    while open_ends:
        pairs = list(open_ends)
        sizes = np.cumsum([len(open_ends[p]) + 1 for p in pairs])
        portions = np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(sizes // INTERVAL_BUDGET)) + 1)
        fresh = {}
        for portion in portions:
            here: dict[int, list[tuple[int, int, int, np.ndarray]]] = {}
            for slot in portion:
                (m, node), f = pairs[slot]
                here.setdefault(m, []).append((int(slot), node, f, open_ends[pairs[slot]]))

            def kernel(batch, here=here):
                bins, margins = read(batch)
                y, n = vector(batch, "y"), vector(batch, "n")
                out = {}
                for m, wanted in here.items():
                    tree, order = routes[m]
                    a, b = used[m].channels(y, n, margins[m])
                    node_of = order[tree.route(bins)]
                    inside: dict[int, np.ndarray] = {}
                    for slot, node, f, ends in wanted:
                        if node not in inside:
                            inside[node] = np.flatnonzero(node_of == node)
                        own = inside[node]
                        if len(own):
                            out[slot] = stats(bins[own, f], ends, a[own], b[own])
                return out

            for slot, cells in rows.intervals(kernel).items():
                fresh[pairs[slot]] = cells
        for (key, f), finer in fresh.items():
            known[key][f] = finer if known[key][f] is None else known[key][f].refined(parted[key, f], finer)
        open_ends, parted = {}, {}
        for key in dict.fromkeys(key for key, _ in fresh):
            search = SplitSearch(models[key[0]].rule(), TIE, known[key])
            for f, which in search.unsettled().items():
                parted[key, f], open_ends[key, f] = which, known[key][f].ends(which, PIECES)
    for key in asked:
        yield key, SplitSearch(models[key[0]].rule(), TIE, known[key])


def _level(rows: BoostRows | HeldRows, models: Sequence[Booster], growers: dict[int, Grower], asked: list[tuple[int, int]]) -> None:
    """Brings the growers all the nodes they ask for."""
    if isinstance(rows.cuts, ExactCuts):
        for (i, node), search in _split_searches(rows, models, growers, asked):
            growers[i].feed_split(node, search.sums(), search.best)
        return
    size = len(rows.cuts.features) * rows.cuts.n_bins * 2
    keep = size * len(asked) <= HELD_BUDGET
    count, derived = [], []
    for i in dict.fromkeys(i for i, _ in asked):
        some, rest = growers[i].halves([node for m, node in asked if m == i])
        count += [(i, node) for node in some]
        derived += [(i, *r) for r in rest]
    siblings = {(i, light): (heavy, parent) for i, heavy, parent, light in derived}
    for (i, node), hist in _histograms(rows, models, growers, count):
        if (i, node) in siblings:
            heavy, parent = siblings[i, node]
            rest = growers[i].remainder(parent, hist)
            growers[i].release([parent])
            growers[i].feed(heavy, rest, keep)
        growers[i].feed(node, hist, keep)


def _write_margins(rows: BoostRows | HeldRows, models: Sequence[Booster]) -> BoostRows | HeldRows:
    """New table with all trees so far inside the margins; cuts the lineage."""
    read = _margin_reader(models, rows.written, len(rows.cuts.features), rows.cuts.dtype)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, margins = read(batch)
                keep = [batch.column(batch.schema.get_field_index(c)) for c in ("bins", "y", "n")]
                yield pa.RecordBatch.from_arrays(
                    [*keep, byte_column(np.column_stack(margins))], names=["bins", "y", "n", "margins"]
                )

    return rows.rewritten(run, max(len(m.trees) for m in models))


def train(rows: BoostRows | HeldRows, models: Sequence[Booster], rounds: int, max_depth: int | None) -> BoostRows | HeldRows:
    """Grow all models side by side; returns the rows with their latest margins.  Tables
    written on the way are released when superseded, the given rows stay cached."""
    given, refresh = rows, rows.refresh or REFRESH
    for done in range(1, rounds + 1):
        live = [i for i, m in enumerate(models) if not m.stopped]
        if not live:
            break
        growers = {i: Grower(models[i].rule(), max_depth, models[i].params.get("max_leaf_nodes")) for i in live}
        while asked := [(i, node) for i in live for node in growers[i].wanted()]:
            _level(rows, models, growers, asked)
        for i in live:
            models[i].accept(growers[i])
        if done % refresh == 0 and done < rounds:
            older, rows = rows, _write_margins(rows, models)
            if older is not given:
                older.release()
    return rows


def _train_one(rows: BoostRows, model: Booster, rounds: int, max_depth: int | None) -> None:
    try:
        last = train(rows, [model], rounds, max_depth)
        if last is not rows:
            last.release()
    finally:
        rows.release()


def _newton_base(rows: BoostRows, base_margin: float | None) -> float:
    """Start margin: one Newton step from probability one half, unless given."""
    if base_margin is not None:
        return base_margin
    t = rows.kept.df.agg((F.sum(F.col("y") * F.col("n")) / F.sum("n")).alias("rate")).first()
    return 4.0 * (t["rate"] - 0.5)


def newton_boost(
    df: DataFrame, y: str, x: Sequence[str], eta: float = 0.3, rounds: int = 100, max_depth: int = 6,
    reg_lambda: float = 1.0, min_child_weight: float = 1.0, max_bins: int = 256, base_margin: float | None = None,
) -> Booster:
    """Second-order boosted trees for a 0/1 label."""
    rows = boost_rows(df, y, x, max_bins, "value")
    params = {"eta": eta, "reg_lambda": reg_lambda, "min_child_weight": min_child_weight}
    model = Booster("newton", rows.cuts, params, base=_newton_base(rows, base_margin))
    _train_one(rows, model, rounds, max_depth)
    return model


def adaboost(
    df: DataFrame, y: str, x: Sequence[str], rounds: int = 50, learning_rate: float = 1.0,
    max_leaf_nodes: int | None = None, variant: str = "samme.r", max_bins: int = 256,
) -> Booster:
    """AdaBoost over Gini trees for a 0/1 label: stumps, or best-first trees with a leaf cap.

    ``samme.r`` boosts on leaf probabilities, ``samme`` on leaf classes.  Training stops early
    at a perfect tree (and, for ``samme``, at one no better than chance)."""
    rows = boost_rows(df, y, x, max_bins, "midpoint")
    model = Booster(variant, rows.cuts, {"learning_rate": learning_rate, "max_leaf_nodes": max_leaf_nodes})
    _train_one(rows, model, rounds, None if max_leaf_nodes else 1)
    return model


def hist_tree(
    df: DataFrame, y: str, x: Sequence[str], max_leaf_nodes: int | None = None, max_depth: int | None = None,
    max_bins: int = 256,
) -> Booster:
    """One Gini classification tree, grown best-first under a leaf cap or level by level."""
    rows = boost_rows(df, y, x, max_bins, "midpoint")
    model = Booster("tree", rows.cuts, {"learning_rate": 1.0, "max_leaf_nodes": max_leaf_nodes})
    _train_one(rows, model, 1, max_depth)
    return model


# ---- parameter sweeps ------------------------------------------------------------------


def grid(start: float, stop: float, step: float) -> list[float]:
    """start, start + step, ... below stop."""
    return [start + i * step for i in range(max(0, math.ceil((stop - start) / step)))]


def product(**axes: Sequence) -> list[dict]:
    """All combinations of the named axes, the first axis varying slowest."""
    out = [{}]
    for name, values in axes.items():
        out = [{**o, name: v} for o in out for v in values]
    return out


def _accuracies(rows: BoostRows | HeldRows, models: Sequence[Booster]) -> list[float]:
    read = _margin_reader(models, rows.written, len(rows.cuts.features), rows.cuts.dtype)

    def kernel(batch, read=read):
        _, margins = read(batch)
        y, n = vector(batch, "y"), vector(batch, "n")
        right = [float(n[(m > 0) == (y == 1)].sum()) for m in margins]
        return {0: np.array([n.sum(), *right])}

    got = dense(rows.sums(kernel), 0, len(models) + 1)
    return [float(v / got[0]) if got[0] else float("nan") for v in got[1:]]


def _held(rows: BoostRows) -> HeldRows | None:
    """The rows themselves where they are folded and few."""
    table = rows.kept.df.limit(HELD_ROWS + 1).toArrow()
    if table.num_rows > HELD_ROWS or not table.num_rows:
        return None
    return HeldRows(table.combine_chunks().to_batches()[0], rows.cuts)


def _fit_points(train_rows: HeldRows, test_rows: HeldRows, models: list[Booster], rounds: int, depths: list[int | None], spark: SparkSession) -> list[tuple]:
    """(train_acc, test_acc) of every model: the models are dealt to the tasks, each with the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("id").to_pylist():
                model = models[i]
                fitted = train(train_rows, [model], rounds, depths[i])
                got = (_accuracies(fitted, [model])[0], _accuracies(test_rows, [model])[0])
                yield pa.record_batch([pa.array([i]), *[pa.array([g]) for g in got]], ["id", "train_acc", "test_acc"])

    dealt = spark.range(0, len(models), 1, len(models)).mapInArrow(run, "id long, train_acc double, test_acc double")
    return [(r["train_acc"], r["test_acc"]) for r in sorted(dealt.collect(), key=lambda r: r["id"])]


def sweep(
    kind: str, points: Sequence[dict], train_df: DataFrame, test_df: DataFrame, y: str, x: Sequence[str],
    rounds: int | None = None, max_depth: int | None = None, max_bins: int = 256,
) -> DataFrame:
    """``(params..., train_acc, test_acc)`` for every grid point.

    ``kind``: newton (eta, min_child_weight, reg_lambda) or an AdaBoost variant (learning_rate,
    max_leaf_nodes).  All points share one binning.  Where rows repeat so often that at most
    50,000 different ones are left, the points are dealt to the tasks; otherwise the rows are, and
    the points are trained side by side with one pass per tree level for all of them.  A parameter
    that is None gives a null.
    """
    newton = kind == "newton"
    defaults = (
        {"eta": 0.3, "reg_lambda": 1.0, "min_child_weight": 1.0}
        if newton
        else {"learning_rate": 1.0, "max_leaf_nodes": None}
    )
    rounds = rounds or (100 if newton else 50)
    spark = train_df.sparkSession
    scan = scan_features(train_df, x, max_bins)
    cuts = find_cuts(train_df, scan, max_bins, "value" if newton else "midpoint")
    fold = scan.fold is not None
    rows = binned(train_df, y, cuts, fold, fold)
    train_rows = BoostRows(keep_folded(rows, scan.fold) if fold else keep_for_passes(rows, scan.occupied), cuts)
    tested = binned(test_df, y, cuts, fold)
    test_tasks = with_task(tested.select("y")).agg(occupied_partitions()).first()[0]
    test_rows = BoostRows(keep_for_passes(tested, test_tasks), cuts)
    base = _newton_base(train_rows, None) if newton else 0.0
    params = [{**defaults, **p} for p in points]
    depths = [max_depth if max_depth is not None else (6 if newton else None if p.get("max_leaf_nodes") else 1) for p in params]
    results: dict[int, tuple] = {}
    held = (_held(train_rows), _held(test_rows)) if fold else (None, None)
    if all(held):
        got = _fit_points(*held, [Booster(kind, cuts, p, base=base) for p in params], rounds, depths, spark)
        results = dict(enumerate(got))
    # points with and without a leaf cap have different depth limits, so they train apart
    for depth in dict.fromkeys(depths) if not results else ():
        alike = [i for i, d in enumerate(depths) if d == depth]
        for start in range(0, len(alike), SWEEP_WIDTH):
            part = alike[start : start + SWEEP_WIDTH]
            models = [Booster(kind, cuts, params[i], base=base) for i in part]
            fitted = train(train_rows, models, rounds, depth)
            results |= {i: pair for i, *pair in zip(part, _accuracies(fitted, models), _accuracies(test_rows, models))}
            if fitted is not train_rows:
                fitted.release()
    train_rows.release()
    test_rows.release()
    names = ", ".join(f"{k} double" for k in points[0])
    told = [(*(None if v is None else float(v) for v in points[i].values()), *results[i]) for i in range(len(points))]
    return spark.createDataFrame(told, f"{names}, train_acc double, test_acc double")


def best_of(sweep_df: DataFrame, metric: str, params: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Grid point of greatest metric, per ``by`` group; ties go to the lowest parameters."""
    rank = F.struct(F.col(metric), *[-quoted(p) for p in params])
    best = F.max_by(F.struct(*params, metric), rank).alias("_best")
    return sweep_df.groupBy(*by).agg(best).select(*by, "_best.*")
