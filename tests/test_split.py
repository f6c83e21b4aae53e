import math

import pytest
from pyspark.sql import functions as F

from riskframe.operators import split as P


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(5000).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("label"))


def ids(df):
    return {r["id"] for r in df.select("id").collect()}


@pytest.mark.parametrize("split", [
    lambda df: P.split_stratified(df, "label", 0.3, 25, ["id"]),
    lambda df: P.split_exact(df, 0.3, 123, ["id"]),
])
def test_splits_do_not_depend_on_partitions(people, split):
    parts = [split(people.repartition(n)) for n in (1, 2, 8)]
    tests = [ids(test) for _, test in parts]
    assert tests[0] == tests[1] == tests[2]
    train = ids(parts[0][0])
    assert not train & tests[0] and train | tests[0] == set(range(5000))


def test_strata_keep_their_share(people):
    _, test = P.split_stratified(people, "label", 0.3, 25, ["id"])
    share = {r["label"]: r["count"] for r in test.groupBy("label").count().collect()}
    assert abs(share["rare"] / 500 - 0.3) < 0.08 and abs(share["common"] / 4500 - 0.3) < 0.03


@pytest.mark.parametrize("n,size", [(10, 0.3), (11, 0.3), (1000, 0.305), (3, 0.0), (7, 1.0)])
def test_exact_sizes(spark, n, size):
    train, test = P.split_exact(spark.range(n), size, 1, ["id"])
    assert test.count() == math.ceil(round(size * n, 9)) and train.count() + test.count() == n


def test_exact_split_refuses_copies(spark):
    same = spark.range(100).select(F.lit(1).alias("id"))
    with pytest.raises(ValueError, match="not unique"):
        P.split_exact(same, 0.3, 1, ["id"])
    _, test = P.split_exact(P.with_row_key(same), 0.3, 1)
    assert test.count() == 30


def test_row_key_spreads_many_copies(spark, monkeypatch):
    monkeypatch.setattr(P, "COPIES_PER_BLOCK", 10)
    df = spark.createDataFrame([("x", None)] * 37 + [("y", 1)] * 10 + [(None, 2)], "a string, b int")
    keyed = P.with_row_key(df)
    assert keyed.count() == 48 and keyed.select("row_key").distinct().count() == 48
    assert sorted(r["count"] for r in keyed.groupBy("a", "b").count().collect()) == [1, 10, 37]


def test_latest_keeps_one_row_per_key(spark):
    df = spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (2, 1, "only")], "k int, t int, v string")
    out = P.latest_per_key(df, ["k"], ["t"])
    assert sorted(map(tuple, out.collect())) == [(1, 9, "new"), (2, 1, "only")] and out.columns == df.columns


def test_sample_and_sets(people):
    first = P.sample_n(people, 100, 25, ["id"])
    assert first.count() == 100 and ids(first) == ids(P.sample_n(people.repartition(9), 100, 25, ["id"]))
    rest = P.without(people, first, ["id"])
    assert rest.count() == 4900 and P.union_all(rest, first).count() == 5000
    assert {r["label"]: r["fraction"] for r in P.strata_fractions(people, "label", 0.3).collect()} == {"rare": 0.3, "common": 0.3}


def test_keys_of_different_rows_differ(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("\\N", "x"), (None, "x"), ("~", "x"), ("", "x"), ("1:a", "b"), ("a", "1:b"), (None, None), ("", "")]
    keyed = P.with_row_key(spark.createDataFrame(rows, "a string, b string"))
    assert keyed.select("row_key").distinct().count() == len(rows)
    natural = P.with_row_key(spark.createDataFrame(rows, "a string, b string"), ["a", "b"])
    assert natural.select("row_key").distinct().count() == len(rows)
