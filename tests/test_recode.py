import pytest
from pyspark.sql import functions as F

from riskframe.functions import columns as C
from riskframe.functions import recode as R


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([("Yes",), ("No",), (None,), ("maybe",), (" yes ",)], "v string")


def test_binary_is_int_and_keeps_null(labels):
    assert values(labels, R.recode_binary("v")) == [1, 0, None, None, None]
    assert labels.select(R.recode_binary("v").alias("x")).dtypes == [("x", "int")]


def test_binary_can_raise(labels):
    with pytest.raises(Exception, match="unmapped label: "):
        labels.select(R.recode_binary("v", unmatched="error")).collect()
    assert values(labels.filter("v is null or v = 'No'"), R.recode_binary("v", unmatched="error")) == [0, None]


def test_many_binary_columns_are_one_projection(labels):
    wide = labels.select("v", F.col("v").alias("w"))
    out = R.recode_binary_columns(wide, ["v", "w"])
    assert [tuple(r) for r in out.collect()][:2] == [(1, 1), (0, 0)]


def test_ordinal_and_lookup(spark):
    df = spark.createDataFrame([("low",), ("high",), ("odd",), (None,)], "v string")
    codes = R.ordinal_levels(["low", "mid", "high"])
    assert codes == {"low": 1, "mid": 2, "high": 3}
    assert values(df, R.recode_ordinal("v", codes)) == [1, 3, None, None]
    with pytest.raises(Exception, match="unmapped label: odd"):
        df.select(R.recode_ordinal("v", codes, unmatched="error")).collect()
    assert values(df, R.lookup("v", {"low": "L"})) == ["L", None, None, None]
    assert values(df, R.lookup("v", {"low": "L"}, default="?")) == ["L", "?", "?", None]


def test_rules_take_the_first_match(spark):
    df = spark.createDataFrame([("abc",), ("xbz",), ("zzz",), (None,)], "v string")
    rules = [("startswith", "a", "first"), ("contains", "b", "second"), ("equals", "zzz", "third")]
    assert values(df, R.recode_rules("v", rules)) == ["first", "second", "third", None]
    assert values(df, R.recode_rules("v", rules[:1])) == ["first", "xbz", "zzz", None]


def test_threeway_keeps_null(spark):
    df = spark.createDataFrame([("hi",), ("lo",), ("x",), (None,)], "v string")
    assert values(df, R.recode_threeway("v", "hi", "lo")) == [2, 0, 1, None]


def test_canonical_then_replace_is_not_full_mapping(spark):
    df = spark.createDataFrame([(" M ",), ("Male",), ("f",)], "v string")
    out = R.replace_values(df.withColumn("v", R.canonical("v")), {"m": "Male", "f": "Female"}, ["v"])
    assert values(out, "v") == ["Male", "male", "Female"]


def test_bins_casts_greatest_text(spark):
    df = spark.createDataFrame([(39.0, "7"), (40.0, "x"), (None, None)], "n double, t string")
    assert values(df, R.bin_numeric("n", [40, 55], ["young", "mid", "old"])) == ["young", "mid", None]
    assert values(df, R.cast_to("t", "int")) == [7, None, None]
    assert values(df, R.greatest_of("n", F.lit(None).cast("double"))) == [39.0, 40.0, None]
    assert values(df, R.replace_text("t", "x", "_")) == ["7", "_", None]
    with pytest.raises(ValueError):
        R.bin_numeric("n", [1], ["a"])


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["b", "Unnamed: 0", "y", "a.c"])
    assert C.drop_matching(df, "^Unnamed").columns == ["b", "y", "a.c"]
    assert C.feature_columns(df, ["y", "Unnamed: 0"]) == ["a.c", "b"]
    assert C.features_target(C.align(df, ["y", "b"]), "y").columns == ["b", "y"]
    assert C.rename_matching(df, [(r"\.", ",")]).columns == ["b", "Unnamed: 0", "y", "a,c"]
    assert C.missing_columns(["b", "q", "a.c"], df) == ["q"]
    with pytest.raises(ValueError, match="missing columns: q"):
        C.require_columns(df, ["q"])
    with pytest.raises(ValueError):
        C.rename_matching(df, [(".*", "same")])
    assert [r["name"] for r in C.describe_schema(df).orderBy("position").collect()] == df.columns


def test_unmatched_codes_can_be_kept(spark):
    df = spark.createDataFrame([("Yes",), ("1",), ("0",), ("maybe",), (None,)], "v string")
    got = df.select(R.recode_binary("v", unmatched="keep").alias("b"), R.recode_ordinal("v", {"maybe": 7}, unmatched="keep").alias("o")).collect()
    assert [r.b for r in got] == [1, 1, 0, None, None]
    assert [r.o for r in got] == [None, 1, 0, 7, None]
    assert df.agg(R.unmapped("v", ["Yes", "No"]).alias("n")).first()["n"] == 3
