"""Cells of the Jaccard join, and rows that share an id."""

import random

import numpy as np
import pytest

from riskframe.llm import jaccard_join

DOCS = "doc_id long, text string"


def cells(own, common, percent):
    places = jaccard_join.prefix(own, common, percent).tolist()
    return set(zip([None, *places], places))


@pytest.mark.parametrize("percent", [85, 60, 95])
def test_sets_within_the_threshold_share_a_cell(percent):
    rng = np.random.default_rng(percent)
    met = 0
    for _ in range(4_000):
        n = int(rng.integers(1, 60))
        base = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        gone = rng.random(len(base)) < rng.choice([0, 0.05, (100 - percent) / 100])
        extra = rng.integers(0, 1 << 62, int(rng.integers(0, 1 + max(1, len(base) * (100 - percent) // 100)))).astype(np.uint64)
        # what differs lies where the order begins, the worst there is
        gone = np.sort(gone)[::-1]
        other = np.unique(np.concatenate([base[~gone], extra >> np.uint64(int(rng.integers(0, 8)))]))
        common = np.sort(rng.choice(base, len(base) // 3, replace=False))
        shared = len(np.intersect1d(base, other))
        if len(other) and 100 * shared >= percent * (len(base) + len(other) - shared):
            met += 1
            assert cells(base, common, percent) & cells(other, common, percent)
    assert met > 500


@pytest.mark.parametrize("turn", [False, True])
def test_rows_of_one_id_are_compared_each_by_its_own_text(spark, turn):
    word = lambda seed: " ".join(f"w{random.Random(seed * 1000 + i).randrange(10**6)}" for i in range(40))
    a, b = word(1), word(2)
    rows = [(1, a), (1, b), (2, f"{b} more"), (3, f"{a} more"), (4, word(4)), (None, a), (None, word(4)), (5, word(5)), (5, word(5))]
    df = spark.createDataFrame(rows[::-1] if turn else rows, DOCS).repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df).collect()), key=str)
    assert got == sorted([(1, 37, 1), (1, 37, 1), (2, 38, 1), (3, 38, 1), (4, 37, 4), (None, 37, None), (None, 37, None), (5, 37, 5), (5, 37, 5)], key=str)
