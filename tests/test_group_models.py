import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import linear as L
from riskframe.operators.group_models import group_logit_table


@pytest.fixture(scope="module")
def crowd(spark):
    """3,000 small groups, one that holds a third of all rows, one of a single class, null groups."""
    rows = spark.range(60_000).withColumns({"a": F.rand(3) * 4, "b": F.floor(F.rand(4) * 5).cast("int"), "u": F.rand(5)})
    group = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 997 == 1, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("id") % 3001))
    y = (F.col("u") < 1 / (1 + F.exp(2 - F.col("a") + 0.3 * F.col("b")))).cast("int")
    return rows.select(group.alias("grp"), "a", "b", F.when(group == "g7", 1).otherwise(y).alias("y")).persist()


def newton(x, y, penalty=1.0):
    x = np.column_stack([np.ones(len(x)), x])
    ridge, beta = np.r_[0.0, np.full(x.shape[1] - 1, penalty)], np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta = beta + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * beta)
    return beta


@pytest.fixture(scope="module")
def table(crowd):
    # parts of 2,000 rows: the hot group is cut
    return group_logit_table(crowd, "grp", "y", ["a", "b"], rows_per_part=2_000)


def test_every_group_equals_its_own_fit(crowd, table):
    frame = crowd.dropna(subset=["grp"]).toPandas()
    models = {r["grp"]: r for r in table.models.collect()}
    assert set(models) == set(frame["grp"])
    for name, own in frame.groupby("grp"):
        model = models[name]
        assert (model["n"], model["successes"]) == (len(own), own["y"].sum())
        if own["y"].nunique() == 1:
            assert model["coef"] is None and not model["converged"]
        else:
            assert model["converged"]
            assert model["coef"] == pytest.approx(newton(own[["a", "b"]].to_numpy(float), own["y"].to_numpy()), abs=1e-6)


def test_equals_the_fits_on_the_driver(crowd):
    few = crowd.where("grp in ('hot', 'g7', 'g1', 'g2')")
    fits = L.per_group_logit(few, "grp", "y", ["a", "b"]).fits
    for r in group_logit_table(few, "grp", "y", ["a", "b"]).models.collect():
        assert (r["coef"] is None) == (fits[r["grp"]] is None)
        if r["coef"]:
            assert r["coef"] == pytest.approx(fits[r["grp"]].coef, abs=1e-7)


def test_scores_and_importances(crowd, table):
    scored = table.score(crowd, threshold=0.5)
    assert scored.count() == crowd.count()
    assert scored.where("prob is null and grp is not null and grp <> 'g7'").join(table.models.where("coef is not null"), "grp").isEmpty()
    assert scored.where("grp is null and prob is not null").isEmpty()
    one = table.models.where("grp = 'hot'").first()["coef"]
    r = scored.where("grp = 'hot'").first()
    assert r["prob"] == pytest.approx(1 / (1 + np.exp(-(one[0] + one[1] * r["a"] + one[2] * r["b"]))))
    assert {tuple(v) for v in table.to_df().where("grp = 'hot'").collect()} == {("hot", "a", one[1]), ("hot", "b", one[2])}
    assert table.to_df().where("grp = 'g7' and importance is null").count() == 2


def test_no_rows_give_no_models(crowd):
    empty = group_logit_table(crowd.where("a > 99"), "grp", "y", ["a", "b"])
    assert empty.models.isEmpty() and empty.to_df().isEmpty()
    assert empty.score(crowd.limit(5)).where("prob is not null").isEmpty()


def test_clashing_names(spark):
    rows = [(i % 4, float(i % 7), i % 3 % 2, "x") for i in range(200)]
    df = spark.createDataFrame(rows, "part int, n double, s int, g string")
    made = group_logit_table(df, "part", "s", ["n"]).models.select(F.col("part"), "coef").collect()
    fits = L.per_group_logit(df, "part", "s", ["n"]).fits
    assert len(made) == 4
    for r in made:
        assert r["coef"] == pytest.approx(fits[r["part"]].coef, abs=1e-7)


def test_small_groups_are_fitted_in_one_reading(crowd, monkeypatch):
    """No state passes between tasks for groups that a task can hold; cut ones come to the same."""
    from riskframe.operators import group_models as G

    few = crowd.where("grp in ('hot', 'g7', 'g1', 'g2', 'g11')")
    cut = {r["grp"]: r for r in group_logit_table(few, "grp", "y", ["a", "b"], rows_per_part=1).models.collect()}
    monkeypatch.setattr(G, "_step", lambda *_, **__: pytest.fail("a pass over the states"))
    whole = {r["grp"]: r for r in group_logit_table(few, "grp", "y", ["a", "b"]).models.collect()}
    assert set(whole) == set(cut) == {"hot", "g7", "g1", "g2", "g11"}
    for g, one in whole.items():
        assert (one["n"], one["successes"], one["converged"], one["iterations"]) == tuple(cut[g][c] for c in ("n", "successes", "converged", "iterations"))
        assert one["coef"] == (cut[g]["coef"] and pytest.approx(cut[g]["coef"], abs=1e-9))
