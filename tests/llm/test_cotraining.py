"""What the two views tell each other about the pool, held against plain numpy."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import cotraining as c


@pytest.fixture(scope="module")
def plain(spark):
    """Pool, labelled rows and models of a small corpus of two kinds of text."""
    rng = np.random.default_rng(3)
    kinds = (["clear", "prose", "about", "rivers", "and", "hills"], ["BUY", "now", "cheap", "!!!", "click", "$$$"])
    rows = []
    for i in range(900):
        y = int(rng.random() < 0.6)
        words = [kinds[y if rng.random() < 0.8 else 1 - y][k] for k in rng.integers(0, 6, rng.integers(3, 40))]
        rows.append((i, " ".join(words), ["en", "de", None][i % 3], f"s{i % 5}" if i % 7 else f"rare{i}", y))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, y int")
    views = c.Views({w: i for i, w in enumerate(sorted(set(sum(kinds, []))))}, {"en": 1, "de": 2}, {f"s{k}": k + 1 for k in range(5)})
    found = c._features(docs.where("doc_id < 150"), views, ["doc_id", "y"]).orderBy("doc_id").collect()
    pool = c._features(docs.where("doc_id >= 150"), views, ["doc_id"]).drop("doc_id")
    pool = pool.repartition(5).persist()
    x = {v: c.design([(r[f"{v[0]}_dense"], r[f"{v[0]}_own"]) for r in found], n) for v, n in zip(c.VIEWS, views.columns())}
    inside = pool.collect()
    free = {v: c.design([(r[f"{v[0]}_dense"], r[f"{v[0]}_own"]) for r in inside], n) for v, n in zip(c.VIEWS, views.columns())}
    return views, pool, x, np.array([r["y"] for r in found]), free


def brute_labels(model, free):
    """Pseudo-labels from dense matrices, round by round."""
    out = {v: np.full(len(free["content"]), -1) for v in c.VIEWS}
    for r in model.past:
        for teacher, learner in c.TEACHES:
            logit = r.lines[teacher].logit(free[teacher].astype(float))
            place = np.floor((np.minimum(abs(logit), c.MOST) - np.log(r.sure / (1 - r.sure))) / (c.MOST - np.log(r.sure / (1 - r.sure))) * c.BINS)
            for y in (0, 1):
                new = (out[learner] < 0) & ((logit > 0) == y) & (place >= max(0, r.cuts[learner, y]))
                out[learner][new] = y
    return out


def test_rounds_equal_brute_force(plain):
    views, pool, x, y, free = plain
    model = c.co_train(views, x["content"], x["metadata"], y, pool, passes=30)
    labels = brute_labels(model, free)
    assert [sum(r[i] for r in model.rounds) for i in (0, 1)] == [(labels[v] >= 0).sum() for v in c.VIEWS]
    assert all(sum(r) for r in model.rounds[: len(model.past)]) and (labels["metadata"] >= 0).sum() > 100
    held = np.arange(0, len(y), 3)
    train = np.setdiff1d(np.arange(len(y)), held)
    for view in c.VIEWS:
        # the last fit: labelled and pseudo-labelled rows in one matrix, solved in one place
        line, told = getattr(model, view), labels[view] >= 0
        z = np.concatenate([line.inputs(x[view][train]), line.inputs(free[view][told])]).astype(float)
        target = np.r_[y[train], labels[view][told]]
        weight = np.r_[np.ones(len(train)), np.full(told.sum(), 0.5 * min(1, len(train) / told.sum()))]
        ridge = np.r_[1e-3, np.full(z.shape[1] - 1, 0.5)]

        def loss(w):
            m = z @ w
            return (weight * (np.logaddexp(0, m) - target * m)).sum() + 0.5 * (ridge * w * w).sum()

        w = np.zeros(z.shape[1])
        for _ in range(100):
            p = c.logistic(z @ w)
            step = np.linalg.solve((z.T * (weight * p * (1 - p))) @ z + np.diag(ridge), z.T @ (weight * (target - p)) - ridge * w)
            size = 1.0
            while loss(w + size * step) > loss(w) and size > 1e-9:
                size /= 2
            w = w + size * step
        assert loss(line.weights) == pytest.approx(loss(w), rel=2e-3)


def test_cuts_take_whole_bins_from_the_surest_down():
    counts = np.zeros(c.BINS)
    counts[[10, 200, 500]] = 7, 5, 3
    assert c.cut_at(counts, 0) == (c.BINS, 0)
    assert c.cut_at(counts, 3) == (500, 3)
    assert c.cut_at(counts, 4) == (200, 8)
    assert c.cut_at(counts, 100) == (0, 15)


def test_gradients_of_the_pool(plain):
    views, pool, x, y, free = plain
    model = c.co_train(views, x["content"], x["metadata"], y, pool, rounds=1)
    line = replace(model.content, weights=model.content.weights + 0.1)
    step = np.linspace(-1, 1, len(line.weights))
    got = c.over(pool, lambda parts: c.losses(parts, model.past, {"content": (line, step)}, (0.0, 0.5)))
    labels = brute_labels(model, free)["content"]
    z, t = line.inputs(free["content"][labels >= 0]).astype(float), labels[labels >= 0]
    for i, size in enumerate((0.0, 0.5)):
        m = z @ (line.weights + size * step)
        assert got[f"content:{i}"][0] == pytest.approx((np.logaddexp(0, m) - t * m).sum(), rel=1e-4)
        assert np.allclose(got[f"content:{i}"][1:], (c.logistic(m) - t) @ z, rtol=1e-3, atol=1e-3)


def test_rare_kinds_among_many_are_told(spark):
    """Rows of a source rarer than 1 in 4,000 get pseudo-labels, and a hot text is told as one."""
    base = spark.range(12_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 6_000 == 5_999, F.lit("BAD!! " * 9)).otherwise(F.concat(F.lit("good words here "), F.expr("repeat('more ', int(id % 3))"))).alias("text"),
    )
    train = spark.range(20_000, 21_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("BAD!! " * 9)).otherwise(F.lit("good words here more")).alias("text")
    )
    docs = base.unionByName(train).select("*", F.lit("en").alias("lang"), F.when(F.col("text").startswith("BAD"), "rare").otherwise("usual").alias("source"))
    labels = train.select("doc_id", F.col("text").startswith("good").cast("int").alias("label"))
    model = c.fit_quality(docs, labels)
    pool = c._features(docs.where("doc_id < 12000"), model.views, ["doc_id"])
    found = [(r.doc_id, c.told({v: one(r, v) for v in c.VIEWS}, model.past)) for r in pool.where("doc_id % 6000 = 5999").collect()]
    assert len(found) == 2 and all(t[v][0] == 0 for _, t in found for v in c.VIEWS)


def one(row, view):
    own = np.array(row[f"{view[0]}_own"], int)
    return c.Part(np.array([row[f"{view[0]}_dense"]], float), own, np.zeros(len(own), int))


def test_values_without_a_column_share_hashed_ones():
    known = {"a": 1, "b": 2}
    assert [c.value_column(v, known) for v in (None, "a", "b")] == [0, 1, 2]
    places = {c.value_column(f"v{i}", known) for i in range(2_000)}
    assert min(places) == 3 and max(places) == 2 + c.RARE and len(places) == c.RARE


def test_repeated_keys_and_an_empty_pool(spark):
    rows = [(i // 2, ("good words here " if (i // 2) % 2 else "BAD!! ") * (3 + i % 2), "en", "s") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label"))
    models = [c.fit_quality(d, labels) for d in (docs, docs.orderBy(F.desc("text")))]
    assert models[0].rounds == [] and np.array_equal(models[0].content.weights, models[1].content.weights)
    kept = c.score_quality(docs, models[0]).where("kept").select("doc_id").distinct().collect()
    assert {r.doc_id % 2 for r in kept} == {1}
    assert c.score_quality(docs, models[0]).count() == len(rows)
