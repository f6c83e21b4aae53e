import numpy as np
import pytest
from pyspark.ml.feature import MinMaxScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.operators import features as S
from riskframe.operators import ranks
from riskframe.operators.design import design, dummy_columns, factor, factors
from riskframe.operators.profile import sketch_ranks


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame(
        [(1.0, 7.0, None), (2.0, 7.0, 4.0), (5.0, 7.0, float("nan")), (9.0, 7.0, 4.0), (9.0, 7.0, 10.0)],
        "a double, flat double, gap double",
    )


def test_minmax_equals_the_ml_scaler(numbers):
    ours = S.minmax_scale(numbers, ["a", "flat"])
    vec = S.assemble(numbers, ["a", "flat"], "v")
    theirs = MinMaxScaler(inputCol="v", outputCol="s").fit(vec).transform(vec).select(vector_to_array("s").alias("s"))
    assert [list(r) for r in ours.select("a_scaled", "flat_scaled").collect()] == [r["s"] for r in theirs.collect()]


def test_minmax_fit_on_and_null(numbers):
    out = S.minmax_scale(numbers, ["gap"], fit_on=numbers.filter("a < 9"), suffix="")
    assert out.first()["gap"] is None


def test_assemble_raises_on_null(numbers):
    with pytest.raises(Exception):
        S.assemble(numbers.select(F.lit(None).cast("double").alias("x")), ["x"], "v").collect()


def test_impute(numbers):
    mean = [r["gap_imp"] for r in S.impute(numbers, ["gap"]).collect()]
    assert mean == [6.0, 4.0, 6.0, 4.0, 10.0]
    assert [r["gap_imp"] for r in S.impute(numbers, ["gap"], "mode").collect()] == [4.0, 4.0, 4.0, 4.0, 10.0]
    assert S.impute(numbers, ["gap"], "median").first()["gap_imp"] == 4.0


def test_winsorize_refuses_a_useless_sketch(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("x"))
    with pytest.raises(ValueError):
        S.winsorize(df, ["x"], rel_error=0.01)
    for exact, slack in ((True, 0), (False, 25)):
        lo, hi = S.winsorize(df, ["x"], exact=exact).agg(F.min("x"), F.max("x")).first()
        assert abs(lo - 100) <= slack and abs(hi - 9900) <= slack


@pytest.mark.parametrize("partitions", [1, 5])
def test_exact_quantiles_narrow_down(spark, monkeypatch, partitions):
    # a coarse sketch and a short list force several rounds
    monkeypatch.setattr(ranks, "SKETCH", 20)
    monkeypatch.setattr(ranks, "LISTED", 5)
    rng = np.random.default_rng(3)
    x = np.where(rng.random(4000) < 0.35, 0.25, rng.normal(size=4000))
    y = np.round(rng.exponential(size=4000), 1)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, y double").repartition(partitions)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in ranks.exact_quantiles(df, ["x", "y"], probs).collect()}
    for name, v in (("x", x), ("y", y)):
        assert [got[name, p] for p in probs] == pytest.approx(np.quantile(v, probs).tolist())


def test_exact_quantiles_of_nothing(spark):
    assert ranks.exact_quantiles(spark.createDataFrame([(None,)], "x double"), ["x"], [0.5]).count() == 0


def test_running_totals_over_buckets(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("n"), F.col("id").alias("tag"))
    out = ranks.running_totals(df.repartition(7), "v", ["n"], descending=True, following=["tag"])
    rows = {r["v"]: r for r in out.collect()}
    assert all(rows[float(v)]["cum_n"] == 1001 - v and rows[float(v)]["total_n"] == 1000 for v in range(1, 1001))
    assert rows[1.0]["next_tag"] is None and all(rows[float(v)]["next_tag"] == v - 1 for v in range(2, 1001))


def test_factors_and_designs(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), (None, 3.0), ("c", 4.0)], "f string, x double")
    assert factor(df, "f") == ["a", "b", "c"]
    assert factor(df, "f", baseline="c") == ["c", "a", "b"]
    levels = factors(df, ["f"])
    wide = dummy_columns(df, levels)
    assert wide.columns == ["fa", "fb", "fc", "x"]
    assert [tuple(r)[:3] for r in wide.collect()] == [(0, 1, 0), (1, 0, 0), (None, None, None), (0, 0, 1)]
    d = design(df, ["x", "f"], levels)
    assert d.names == ["x", "fb", "fc"] and d.positions(["f"]) == [1, 2] and d.terms == ["x", "f"]
    with pytest.raises(ValueError, match="too many levels"):
        factors(df, ["f"], max_levels=2)


def test_clean_pipeline_keeps_unseen_labels(spark):
    train = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "a")], "n double, c string")
    fitted = S.clean_pipeline(["n"], ["c"]).fit(train)
    out = fitted.transform(spark.createDataFrame([(None, "zz")], "n double, c string")).first()
    assert out["n_imp"] == 2.0 and out["c_idx"] == 2.0 and len(out["c_oh"]) == 3


def test_sketched_quartiles_against_their_ranks(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 10 != 0, F.hash("id") % 100_003).cast("double").alias("wide"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") % 2).alias("hot"),
        F.lit(None).cast("double").alias("none"),
    )
    found = {(r.column, r.stat): r for r in sketch_ranks(rows, ["wide", "hot", "none"]).collect()}
    assert len(found) == 9
    values = sorted(r.wide for r in rows.where("wide is not null").collect())
    for stat, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        r = found["wide", stat]
        assert r.n == 27_000 and r.within and r.below == sum(v < r.value for v in values) and r.upto == sum(v <= r.value for v in values)
        assert abs(r.upto - p * r.n) <= r.n / 10_000 + 2
        assert found["hot", stat].within and found["hot", stat].n == 30_000
        none = found["none", stat]
        assert (none.value, none.n, none.within) == (None, 0, None)
    assert [found["hot", s].value for s in ("q1", "median", "q3")] == [0.0, 1.0, 7.0]
