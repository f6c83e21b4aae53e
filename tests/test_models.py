import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from riskframe.functions.keys import hash_unit
from riskframe.operators import boost as B
from riskframe.operators import cluster as K
from riskframe.operators import explain as E
from riskframe.operators import linear as L
from riskframe.operators import partials
from riskframe.operators.association import cramers_v
from riskframe.operators.design import factors
from riskframe.operators.stepwise import stepwise_logit
from riskframe.operators.trees import GiniRule, Grower, NewtonRule, best_split


@pytest.fixture(scope="module")
def cohort(spark):
    """600 rows: y follows a and the flag, b is noise."""
    df = spark.range(600).select(
        "id",
        (hash_unit(["id"], 1) * 4).alias("a"),
        F.floor(hash_unit(["id"], 2) * 5).cast("double").alias("b"),
        F.when(hash_unit(["id"], 3) < 0.5, "p").when(hash_unit(["id"], 3) < 0.8, "q").otherwise("r").alias("flag"),
        (hash_unit(["id"], 4) * 3).alias("noise"),
    )
    bump = F.when(F.col("flag") == "r", 1.0).otherwise(0.0)
    return df.withColumn("y", (F.col("a") + bump + F.col("noise") > 3.5).cast("int")).drop("noise").cache()


def spark_glm(df, x):
    v = VectorAssembler(inputCols=x, outputCol="v").transform(df)
    return GeneralizedLinearRegression(family="binomial", labelCol="y", featuresCol="v", tol=1e-12, maxIter=50).fit(v)


@pytest.mark.parametrize("direct", [True, False])
def test_glm_agrees_with_spark(cohort, monkeypatch, direct):
    if not direct:
        monkeypatch.setattr(partials, "DIRECT_TASKS", 0)  # combine partial sums by a shuffle
    fit = L.glm_logit(cohort, "y", ["a", "b"], tol=1e-12)
    ref = spark_glm(cohort, ["a", "b"])
    assert fit.coef == pytest.approx([ref.intercept, *ref.coefficients], rel=1e-6)
    se = list(ref.summary.coefficientStandardErrors)
    assert fit.se == pytest.approx([se[-1], *se[:-1]], rel=1e-5)
    assert [r[4] for r in fit.rows()] == pytest.approx([ref.summary.pValues[-1], *ref.summary.pValues[:-1]], abs=1e-8)
    s = fit.stats
    assert s["deviance"] == pytest.approx(ref.summary.deviance) and s["aic"] == pytest.approx(ref.summary.aic)
    assert s["null_deviance"] == pytest.approx(ref.summary.nullDeviance) and s["df_residual"] == 597
    assert s["aic"] == pytest.approx(s["deviance"] + 2 * 3)


def test_aliased_column_is_null_and_separation_is_flagged(cohort):
    twice = cohort.withColumn("a2", F.col("a") * 2)
    fit = L.glm_logit(twice, "y", ["a", "a2", "b"])
    assert fit.coef[2] is None and fit.stats["df_residual"] == 597
    with pytest.raises(ValueError, match="aliased"):
        L.gvif(twice, "y", ["a", "a2"])
    apart = cohort.withColumn("y", (F.col("a") > 2).cast("int"))
    assert L.glm_logit(apart, "y", ["a"]).stats["converged"] == 0.0


def test_ridge_agrees_with_spark(cohort):
    fit = L.ridge_logit(cohort, "y", ["a", "b"], C=0.5)
    v = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(cohort)
    ref = LogisticRegression(
        labelCol="y", featuresCol="v", regParam=1 / (0.5 * 600), elasticNetParam=0, standardization=False, maxIter=1000, tol=1e-12
    ).fit(v)
    assert fit.coef == pytest.approx([ref.intercept, *ref.coefficients], abs=1e-5)


def test_groups_equal_separate_fits(cohort):
    odd = cohort.withColumn("flag", F.when(F.col("a") > 3.5, "one").otherwise(F.col("flag")))
    fits = L.per_group_logit(odd, "flag", "y", ["a", "b"]).fits
    assert fits["one"] is None
    for g in ("p", "q", "r"):
        alone = L.ridge_logit(odd.filter(F.col("flag") == g), "y", ["a", "b"])
        assert fits[g].coef == pytest.approx(alone.coef, rel=1e-6)


def test_stepwise_path_is_the_path_of_single_fits(cohort):
    terms = ["a", "b", "flag"]
    levels = factors(cohort, ["flag"])
    step = stepwise_logit(cohort, "y", terms, levels)
    coded = cohort.withColumns({f"flag{v}": (F.col("flag") == v).cast("int") for v in "qr"})

    def aic(kept):
        x = [c for t in kept for c in (["flagq", "flagr"] if t == "flag" else [t])]
        return spark_glm(coded, x).summary.aic

    current, value = terms, aic(terms)
    for _, action, term, _, _, reached in step.path[1:]:
        moves = {("drop", t): aic([u for u in current if u != t]) for t in current}
        moves |= {("add", t): aic([*current, t]) for t in terms if t not in current}
        best = min(moves, key=moves.get)
        assert best == (action, term) and moves[best] == pytest.approx(reached, abs=1e-4) and reached < value
        current, value = [t for t in current if t != term] if action == "drop" else [*current, term], reached
    assert sorted(step.terms) == sorted(current)


def test_ols_and_gvif(cohort):
    x = np.array([[r["a"], r["b"]] for r in cohort.select("a", "b").collect()])
    y = np.array([r["y"] for r in cohort.select("y").collect()], dtype=float)
    want = np.linalg.lstsq(np.column_stack([np.ones(600), x]), y, rcond=None)[0]
    assert L.ols(cohort, "y", ["a", "b"]).coef == pytest.approx(want.tolist())
    inflation = 1 / (1 - np.corrcoef(x.T)[0, 1] ** 2)
    assert [r["gvif"] for r in L.gvif(cohort, "y", ["a", "b"]).collect()] == pytest.approx([inflation] * 2)


@pytest.mark.parametrize("dense, held", [(65_536, 2_000_000), (0, 2_000_000), (0, 0)])
def test_cramers_v_in_dense_and_sparse_blocks(cohort, monkeypatch, dense, held):
    monkeypatch.setattr("riskframe.operators.association.DENSE", dense)
    monkeypatch.setattr("riskframe.operators.association.HELD_CELLS", held)
    v = {(r["var_a"], r["var_b"]): r["v"] for r in cramers_v(cohort, ["flag", "b", "y"]).collect()}
    assert len(v) == 9 and v["y", "y"] == 1.0 and v["flag", "y"] == v["y", "flag"]
    rows = cohort.groupBy("flag", "y").count().collect()
    o = np.array([[next((r["count"] for r in rows if r["flag"] == f and r["y"] == k), 0) for k in (0, 1)] for f in "pqr"])
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    assert v["flag", "y"] == pytest.approx(math.sqrt(((o - e) ** 2 / e).sum() / o.sum()))


# ---- clusters --------------------------------------------------------------------------


def test_kmeans_total_ss_labels_and_partitions(cohort):
    v = K.scaled_vector(cohort, ["a", "b"]).cache()
    x = np.array([r["features"] for r in v.select("features").collect()])
    curve = {r["k"]: r["within_ss"] for r in K.elbow(v, "features", [1, 3]).collect()}
    assert curve[1] == pytest.approx(((x - x.mean(0)) ** 2).sum()) and curve[3] < curve[1]
    one, many = (K.kmeans(v.repartition(n), "features", 3) for n in (1, 6))
    assert one.centers == pytest.approx(many.centers)
    labels = {r["cluster"] for r in one.predict(v).select("cluster").collect()}
    assert labels == {1, 2, 3}


def test_kmeans_start_rows_differ(spark):
    crowd = spark.range(1000).select(F.array(F.when(F.col("id") < 997, 0.0).otherwise(F.col("id").cast("double"))).alias("v"))
    assert K.kmeans(crowd, "v", 3).sizes.sum() == 1000
    with pytest.raises(ValueError, match="different rows"):
        K.kmeans(crowd, "v", 9)


# ---- trees -----------------------------------------------------------------------------


def gini_tree_by_hand(x, y, leaves):
    """Best-first growth on raw arrays; returns the class share of every row's leaf."""
    def split(rows):
        best = (-1.0, None)
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1]:
                left = x[rows, f] <= cut
                gain = sum(s * 2 * len(p) * p.mean() * (1 - p.mean()) for p, s in ((y[rows], 1), (y[rows][left], -1), (y[rows][~left], -1)))
                if gain > best[0] + 1e-9:
                    best = (gain, (rows[left], rows[~left]))
        return best

    parts = [np.arange(len(y))]
    while len(parts) < leaves:
        gains = [split(p) for p in parts]
        k = max(range(len(parts)), key=lambda i: gains[i][0])
        parts[k : k + 1] = gains[k][1]
    out = np.empty(len(y))
    for p in parts:
        out[p] = y[p].mean()
    return out


@pytest.mark.parametrize("leaves", [2, 5, 9])
def test_leaf_capped_tree_is_best_first(cohort, leaves):
    rows = cohort.select("id", F.round("a", 1).alias("a"), "b", "y")
    model = B.hist_tree(rows, "y", ["a", "b"], max_leaf_nodes=leaves)
    got = model.predict(rows).orderBy("id").collect()
    x, y = np.array([[r["a"], r["b"]] for r in got]), np.array([r["y"] for r in got], dtype=float)
    want = gini_tree_by_hand(x, y, leaves)
    assert [r["prob"] for r in got] == pytest.approx(want.tolist(), abs=1e-9)
    assert sum(t.feature.size - (t.feature >= 0).sum() for t in model.trees) == leaves


def test_best_split_ties_go_to_the_first_feature():
    hist = np.zeros((2, 3, 2))
    hist[:, 0, 0], hist[:, 2, 1] = 5, 5
    assert best_split(hist, GiniRule())[:3] == (5.0, 0, 0)
    assert best_split(np.zeros((1, 3, 2)), NewtonRule()) is None
    assert Grower(GiniRule(), 1, None).wanted() == [0]


def test_margins_survive_the_rewrites(cohort, monkeypatch):
    args = dict(rounds=7, max_depth=3)
    whole = B.newton_boost(cohort, "y", ["a", "b"], **args)
    monkeypatch.setattr(B, "REFRESH", 2)
    parts = B.newton_boost(cohort, "y", ["a", "b"], **args)
    a, b = (m.predict(cohort, margin="m").orderBy("id").select("m").toPandas()["m"] for m in (whole, parts))
    assert a.to_numpy() == pytest.approx(b.to_numpy())


def test_boosting_learns_and_sweeps(cohort):
    base = cohort.agg(F.avg("y")).first()[0]
    grid = B.product(max_leaf_nodes=[3, 6], learning_rate=[0.1, 1.0])
    out = B.sweep("samme.r", grid, cohort, cohort, "y", ["a", "b"], rounds=4).collect()
    assert len(out) == 4 and all(r["train_acc"] == r["test_acc"] > max(base, 1 - base) for r in out)
    mixed = B.sweep("samme.r", [{"max_leaf_nodes": None}, {"max_leaf_nodes": 6}], cohort, cohort, "y", ["a", "b"], rounds=4).collect()
    stumps = B.sweep("samme.r", [{"max_leaf_nodes": None}], cohort, cohort, "y", ["a", "b"], rounds=4).collect()
    assert mixed[0] == stumps[0] and [r["max_leaf_nodes"] for r in mixed] == [None, 6.0]
    single = B.adaboost(cohort, "y", ["a", "b"], rounds=4, learning_rate=1.0, max_leaf_nodes=6)
    right = single.predict(cohort).agg(F.avg((F.col("pred") == F.col("y")).cast("double"))).first()[0]
    assert right == pytest.approx(out[3]["train_acc"])
    importance = B.tree_importance(single, cohort.sparkSession).collect()
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0) and importance[0]["feature"] == "a"


def test_perfect_tree_stops_adaboost(cohort):
    easy = cohort.withColumn("y", (F.col("b") >= 2).cast("int"))
    for variant in ("samme.r", "samme"):
        model = B.adaboost(easy, "y", ["a", "b"], rounds=5, variant=variant)
        assert len(model.trees) == 1 and model.trees[0].error == 0


def test_null_features_are_refused(cohort):
    with pytest.raises(Exception, match="must not be null"):
        B.newton_boost(cohort.withColumn("a", F.when(F.col("id") > 9, F.col("a"))), "y", ["a"], rounds=1)


def test_grids():
    assert len(B.grid(0.01, 1, 0.05)) == 20 and len(B.grid(0.1, 2.4, 0.3)) == 8 and len(B.grid(10, 50, 10)) == 4
    assert B.product(a=[1, 2], b=[3, 4])[1] == {"a": 1, "b": 4}


def shapley_by_subsets(tree, bins, width):
    """Shapley values of one row from the definition, features left out follow the cover."""
    def value(known, i=0):
        f = tree.feature[i]
        if f < 0:
            return tree.value[i]
        if f in known:
            return value(known, tree.left[i] if bins[f] <= tree.cut[i] else tree.right[i])
        return sum(tree.cover[k] / tree.cover[i] * value(known, k) for k in (tree.left[i], tree.right[i]))

    phi = np.zeros(width)
    for f in range(width):
        others = [g for g in range(width) if g != f]
        for size in range(width):
            w = math.factorial(size) * math.factorial(width - size - 1) / math.factorial(width)
            phi[f] += sum(w * (value({*s, f}) - value(set(s))) for s in itertools.combinations(others, size))
    return phi


@pytest.mark.parametrize("small", [0, 6])
def test_shap_equals_the_definition(cohort, monkeypatch, small):
    monkeypatch.setattr(E, "SMALL_PATH", small)
    wide = cohort.withColumn("c", F.col("a") * F.col("b")).withColumn("d", F.col("id") % 7)
    model = B.newton_boost(wide, "y", ["a", "b", "c", "d"], rounds=2, max_depth=4)
    some = wide.filter("id < 40")
    got = {(r["id"], r["feature"]): r["shap"] for r in E.tree_shap(some, model, ["id"]).collect()}
    names = model.cuts.features
    for r in some.collect():
        bins = model.cuts.bin(np.array([[float(r[c]) for c in names]]))[0]
        want = sum(shapley_by_subsets(t, bins, 4) for t in model.trees)
        assert [got[r["id"], c] for c in names] == pytest.approx(want.tolist(), abs=1e-9)


def test_rows_are_folded_once_they_are_in_bins(spark):
    """A column of more values than bins: different rows, but few of them after binning."""
    rows = spark.range(6_000).select(F.rand(3).alias("a"), F.floor(F.rand(4) * 3).cast("int").alias("b"), F.rand(5).alias("u"))
    df = rows.select("a", "b", (F.col("u") < F.col("a") * 0.6 + F.col("b") * 0.1).cast("int").alias("y")).persist()
    kept = B.boost_rows(df, "y", ["a", "b"], 32, "value")
    table = kept.kept.df.agg(F.count("*").alias("rows"), F.sum("n").alias("n")).first()
    assert table["rows"] <= 32 * 3 * 2 and table["n"] == 6_000
    kept.release()
    folded = B.newton_boost(df, "y", ["a", "b"], rounds=3, max_depth=3, max_bins=32)
    whole = B.BoostRows(B.keep_for_passes(B.binned(df, "y", folded.cuts), 8), folded.cuts)
    model = B.Booster("newton", folded.cuts, folded.params, base=folded.base)
    B._train_one(whole, model, 3, 3)
    for one, other in zip(folded.trees, model.trees):
        assert list(one.feature) == list(other.feature) and list(one.cut) == list(other.cut)
        assert list(one.value) == pytest.approx(list(other.value))


def test_repeated_values_are_counted_before_they_are_coded(spark, monkeypatch):
    values = [(0.0, 1.5, 0), (-0.0, 1.5, 0), (2.25, -3.0, 1), (2.25, -3.0, 0), (1e300, 7.0, 1)]
    df = spark.createDataFrame(values * 40, "a double, b double, y int")
    for cuts in (B.ExactCuts(["a", "b"], []), B.Cuts(["a", "b"], [np.array([1.0, 3.0]), np.array([0.0])], "value")):
        plain, counted = (sorted(map(tuple, B.binned(df, "y", cuts, True, r).collect())) for r in (False, True))
        assert plain == counted and sum(r[2] for r in counted) == 200
    coded = []
    monkeypatch.setattr("riskframe.operators.trees._coded", lambda packed, cuts, run=B.binned.__globals__["_coded"]: (coded.append(packed.count()), run(packed, cuts))[1])
    B.binned(df, "y", cuts, True, True).count()
    assert coded == [4]
