"""k-means starts and assignments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import cluster as K


@pytest.fixture(scope="module")
def blobs(spark):
    """Twelve tight groups of very different sizes, one of them a third of all rows, with copies."""
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(12, 3)) * 20
    sizes = [400, *([40] * 5), *([100] * 6)]
    points = np.concatenate([m + rng.normal(size=(n, 3)) * 0.1 for m, n in zip(middles, sizes)])
    points = np.concatenate([points, points[:100]])
    df = spark.createDataFrame([(p.tolist(),) for p in points], "v array<double>").cache()
    yield df
    df.unpersist()


def test_the_matrix_product_assigns_as_single_distances_do():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.integers(0, 4, (500, 3)).astype(float), 1e6 + rng.normal(size=(200, 3))])
    models = [x[rng.choice(len(x), k)] for k in (1, 2, 7, 20)]
    for (best, gap), model in zip(K._assign_many(x, models), models):
        want, distance = K._assign(x, model)
        assert (best == want).all() and gap == pytest.approx(distance)


def test_oversampled_starts_find_every_group(blobs):
    hashed, oversampled = (K.kmeans(blobs, "v", 12, start=s) for s in ("hashed", "oversampled"))
    assert oversampled.within_ss <= hashed.within_ss
    assert oversampled.within_ss < 100 and sorted(oversampled.sizes)[-1] >= 400


def test_oversampled_starts_do_not_hang_on_the_partitioning(blobs):
    found = [K.oversampled_centers(blobs.repartition(p), "v", 12, 7) for p in (1, 3, 8)]
    for other in found[1:]:
        assert np.array_equal(np.round(found[0], 9), np.round(other, 9))


def test_oversampling_rows_that_hardly_differ(spark):
    same = spark.range(500).select(F.array(F.when(F.col("id") < 496, 0.0).otherwise(F.col("id").cast("double"))).alias("v"))
    assert K.kmeans(same, "v", 3, start="oversampled").sizes.sum() == 500


def test_one_reading_draws_what_the_whole_sum_decides(spark):
    """Every task judges by its own sum so far; the rows drawn are those of the whole sum, copies once."""
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(3_000, 2)) * 5, 2)
    x = np.concatenate([x, x[:500]])
    centers = x[:2]
    gap = ((x[:, None] - centers) ** 2).sum(axis=2).min(axis=1)
    want = np.unique(x[K._draws(x, 4) < 40 / gap.sum() * gap], axis=0)
    for tasks in (1, 7):
        cost, got = K._drawn(spark.createDataFrame([(p.tolist(),) for p in x], "v array<double>").repartition(tasks), centers, 40, 4)
        assert cost == pytest.approx(gap.sum())
        assert len(want) > 10 and np.array_equal(np.unique(got, axis=0), want)


def test_text_of_a_vector_rounds_as_before(spark):
    values = [0.0, -0.0, 0.5e-6, -0.5e-6, 1.5e-6, 2.5e-6, -2.5e-6, 0.49999999999999994e-6, 1 / 3, -2 / 3, 123456.7890125, -1e5, None]
    df = spark.createDataFrame([(values,)], "v array<double>")
    before = F.array_join(F.transform("v", lambda v: F.round(v * 1e6).cast("long").cast("string")), ",")
    one, other = df.select(K._vector_text("v"), before).first()
    assert one == other


def test_ties_and_values_beyond_single_precision():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.integers(0, 3, (300, 2)) * 1e25, rng.random((300, 2)) * 1e-30, np.full((9, 2), 0.5)])
    for model in (np.array([[0.0, 1.0], [1.0, 0.0], [0.0, 1.0]]), x[rng.choice(len(x), 9)]):
        best, gap = K._assign_many(x, [model])[0]
        want, distance = K._assign(x, model)
        assert (best == want).all() and gap == pytest.approx(distance)
