"""Equal-mass cuts and exact splits against brute force, for any partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import boost as B
from riskframe.operators.intervals import GREATEST, LEAST, Intervals, SplitSearch, decode, encode, pieces
from riskframe.operators.trees import TIE, ExactCuts, GiniRule, find_cuts, scan_features
from tests.test_models import gini_tree_by_hand


@pytest.fixture(scope="module")
def skewed(spark):
    """Four features of 3,000 rows: smooth, heavy tails with one value on a third of the rows, few values, signed."""
    rng = np.random.default_rng(8)
    n = 3_000
    tails = np.where(rng.random(n) < 1 / 3, 7.25, np.exp(6 * rng.normal(size=n)))
    x = np.column_stack([rng.normal(size=n), tails, rng.integers(0, 9, n), rng.normal(size=n) * 10.0 ** rng.integers(-9, 9, n)])
    y = (x[:, 0] + 0.3 * np.log(x[:, 1]) + 0.2 * x[:, 2] + rng.normal(size=n) > 1).astype(int)
    rows = [(*map(float, r), int(v)) for r, v in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y int").cache()
    yield df, x, y
    df.unpersist()


def test_codes_keep_the_order():
    x = np.array([-np.inf, -1e300, -1.5, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1e300, np.inf])
    assert (np.diff(encode(x)) >= 0).all() and (decode(encode(x)) == x).all() and encode(x)[4] == encode(x)[5]
    for lo, hi in ((LEAST, GREATEST), (3, 4), (-7, 1_000)):
        ends = pieces(lo, hi, 8)
        assert ends[0] == lo and ends[-1] == hi and (np.diff(ends.astype(object)) > 0).all()


def cuts_of(df, bins, at="value"):
    return find_cuts(df, scan_features(df, list("abcd"), bins), bins, at)


@pytest.mark.parametrize("bins", [16, 40])
def test_cuts_make_equal_parts_whatever_the_partitioning(skewed, bins):
    df, x, _ = skewed
    found = [cuts_of(df.repartition(p), bins) for p in (1, 3, 8)]
    for f in range(4):
        values, below = np.unique(x[:, f]), None
        below = np.searchsorted(np.sort(x[:, f]), values)
        part = below * bins // len(x)
        want = values[1:][np.diff(part) > 0] if len(values) > bins else values[1:]
        for cuts in found:
            assert cuts.points[f].tolist() == want.tolist()


def test_a_model_is_the_same_for_any_partitioning(skewed):
    df, _, _ = skewed
    trees = []
    for p in (1, 3, 8):
        newton = B.newton_boost(df.repartition(p), "y", list("abcd"), rounds=10, max_depth=3, max_bins=32)
        ada = B.adaboost(df.repartition(p), "y", list("abcd"), rounds=3, max_leaf_nodes=5, max_bins=32)
        told = [m.to_df(df.sparkSession).select("tree", "node", "feature", "threshold").collect() for m in (newton, ada)]
        trees.append(told)
    assert trees[0] == trees[1] == trees[2]


@pytest.mark.parametrize("leaves, budget", [(2, 1_000_000), (8, 1_000_000), (8, 500)])
def test_exact_splits_are_those_of_all_values(skewed, monkeypatch, leaves, budget):
    monkeypatch.setattr(B, "INTERVAL_BUDGET", budget)
    df, x, y = skewed
    model = B.hist_tree(df, "y", list("abcd"), max_leaf_nodes=leaves, max_bins=32)
    assert isinstance(model.cuts, ExactCuts)
    got = model.predict(df).toPandas()
    want = gini_tree_by_hand(x, y.astype(float), leaves)
    order = np.lexsort(x.T)
    mine = got[list("abcd")].to_numpy()
    assert got["prob"].to_numpy()[np.lexsort(mine.T)] == pytest.approx(want[order], abs=1e-9)
    # thresholds lie half way between neighbouring values of the node
    root = model.to_df(df.sparkSession).where("node = 0").first()
    v = np.unique(x[:, "abcd".index(root["feature"])])
    i = np.searchsorted(v, root["threshold"])
    assert root["threshold"] == pytest.approx((v[i - 1] + v[i]) / 2)


def test_only_what_can_still_win_is_read_again():
    rng = np.random.default_rng(2)
    x = np.sort(rng.normal(size=20_000))
    y = (x > 0.4) ^ (rng.random(len(x)) < 0.05)
    edges = np.array_split(np.arange(len(x)), 200)
    codes = encode(x)
    cells = Intervals(*(np.array(v) for v in zip(*[(codes[e[0]], codes[e[-1]], float((~y[e]).sum()), float(y[e].sum())) for e in edges])))
    search = SplitSearch(GiniRule(), TIE, [cells])
    assert 0 < search.unsettled()[0].sum() <= 4


def test_counting_one_child_gives_both(skewed, monkeypatch):
    df, _, _ = skewed
    fit = lambda: B.newton_boost(df, "y", list("abcd"), rounds=4, max_depth=4, max_bins=32).to_df(df.sparkSession).toPandas()
    halved = fit()
    monkeypatch.setattr(B, "HELD_BUDGET", 0)
    counted = fit()
    assert halved[["feature", "node"]].equals(counted[["feature", "node"]])
    for c in ("threshold", "leaf_value", "cover", "gain"):
        assert halved[c].to_numpy() == pytest.approx(counted[c].to_numpy(), nan_ok=True)


@pytest.mark.parametrize("kind, points", [("newton", B.product(eta=[0.1, 0.6], min_child_weight=[0, 20])), ("samme.r", B.product(max_leaf_nodes=[None, 5], learning_rate=[0.3, 1.0]))])
def test_dealing_points_or_rows_gives_one_result(skewed, monkeypatch, kind, points):
    df, _, _ = skewed
    few = df.select(F.round("a").alias("a"), "c", "y")
    run = lambda: B.sweep(kind, points, few, few.limit(500), "y", ["a", "c"], rounds=10).toPandas()
    apart = run()
    monkeypatch.setattr(B, "HELD_ROWS", 0)
    together = run()
    assert apart.to_numpy(dtype=float) == pytest.approx(together.to_numpy(dtype=float), nan_ok=True)


def newton_by_hand(x, y, eta, rounds, depth, weight, lam=1.0):
    """Margins of plain second-order boosting over all values."""
    margin = np.full(len(y), 4 * (y.mean() - 0.5))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)

        def grow(rows, left_depth, step):
            score = lambda r: g[r].sum() ** 2 / (h[r].sum() + lam)
            best = (1e-6, None)
            for f in range(x.shape[1]) if left_depth else ():
                for cut in np.unique(x[rows, f])[1:]:
                    parts = rows[x[rows, f] < cut], rows[x[rows, f] >= cut]
                    gain = sum(map(score, parts)) - score(rows)
                    if min(h[q].sum() for q in parts) >= weight and gain > best[0] * (1 + 1e-9):
                        best = (gain, parts)
            if best[1] is None:
                step[rows] = -eta * g[rows].sum() / (h[rows].sum() + lam)
            else:
                for q in best[1]:
                    grow(q, left_depth - 1, step)

        step = np.zeros(len(y))
        grow(np.arange(len(y)), depth, step)
        margin += step
    return margin


def test_sweeps_are_plain_boosting(skewed):
    df, x, y = skewed
    few = df.select(F.round("a").alias("a"), "c", "y")
    xs = np.column_stack([np.array([float(r.a) for r in few.select("a").collect()]), x[:, 2]])
    points = B.product(eta=[0.1, 0.6], min_child_weight=[0, 20])
    got = B.sweep("newton", points, few, few, "y", ["a", "c"], rounds=5, max_depth=3).collect()
    for p, r in zip(points, got):
        margin = newton_by_hand(xs, y, p["eta"], 5, 3, p["min_child_weight"])
        assert r["train_acc"] == r["test_acc"] == pytest.approx(((margin > 0) == (y == 1)).mean())
