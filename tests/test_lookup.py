"""Dictionaries with many labels, and lookups in tables of both sizes."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import features as S
from riskframe.operators import lookup as T
from riskframe.operators.ranks import numbered, running_totals


@pytest.fixture(scope="module")
def labelled(spark):
    """A third of the rows with one label, another part without any."""
    n = F.col("id")
    label = F.when(n % 3 == 0, "hot").when(n % 10 == 1, None).otherwise(F.concat(F.lit("k"), (n % 700).cast("string")))
    return spark.range(6_000).select("id", label.alias("label")).cache()


@pytest.mark.parametrize("broadcast", [64 << 20, 0])
def test_lookup_in_a_table(spark, labelled, monkeypatch, broadcast):
    monkeypatch.setattr(T, "BROADCAST_BYTES", broadcast)
    entries = spark.range(500).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), (F.col("id") * 2).cast("string").alias("v"))
    entries = entries.union(spark.createDataFrame([("hot", "b"), ("hot", "a"), (None, "x"), ("only here", "y")], "k string, v string"))
    got = T.lookup_table(labelled, "label", entries, "k", "v", "found", default="none").collect()
    assert len(got) == 6_000
    for r in got:
        want = None if r.label is None else "a" if r.label == "hot" else str(2 * int(r.label[1:])) if int(r.label[1:]) < 500 else "none"
        assert r.found == want


def test_hot_labels_are_spread(spark, labelled, monkeypatch):
    monkeypatch.setattr(T, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        entries = labelled.select(F.col("label").alias("k"), F.lit("v").alias("v"))
        joined = T.lookup_table(labelled, "label", entries, "k", "v", "found")
        plan = joined._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "_share" in plan and "BroadcastHashJoin" not in plan
        assert joined.where("found is null").count() == labelled.where("label is null").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("order", ["frequencyDesc", "frequencyAsc", "alphabetAsc", "alphabetDesc"])
def test_a_dictionary_table_indexes_as_the_plan_does(labelled, monkeypatch, order):
    listed = S.index_categories(labelled, ["label"], order).orderBy("id").collect()
    monkeypatch.setattr(S, "LISTED_LABELS", 0)
    assert S.index_categories(labelled, ["label"], order).orderBy("id").collect() == listed
    assert S.index_categories(labelled, ["label"], order, invalid="skip").count() == labelled.where("label is not null").count()
    with pytest.raises(Exception, match="is null"):
        S.index_categories(labelled, ["label"], order, invalid="error").collect()


def test_rows_are_numbered_over_all_tasks(spark):
    got = numbered(spark.range(5_000).select((F.col("id") * 7919 % 5003).alias("v")), [F.col("v").desc()], "place", "t").collect()
    assert [r.v for r in sorted(got, key=lambda r: r.place)] == sorted((r.v for r in got), reverse=True)
    assert sorted(r.place for r in got) == list(range(5_000))


def test_running_totals_in_more_buckets_than_a_lookup_could_hold(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "700")
    try:
        df = spark.range(3_000).select((F.col("id") / 7).alias("v"), F.col("id").alias("n"))
        got = running_totals(df, "v", ["n"], following=["n"]).orderBy("v").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    total = 0
    for i, r in enumerate(got):
        total += i
        assert (r.cum_n, r.total_n, r.next_n) == (total, 2_999 * 1_500, i + 1 if i < 2_999 else None)
