import pytest
from pyspark.sql import functions as F

from riskframe.sources.scratch import materialize, scratch_root
from riskframe.sources.tables import CORRUPT, quarantine, read_table, write_table

SCHEMA = "id int, n int, t string"


def test_bad_rows_are_kept_apart(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("id,n,t\n1,5,a\n2,oops,b\n3,7,c,extra\n4,,d\n")
    raw = read_table(spark, str(path), schema=SCHEMA, corrupt_col=CORRUPT)
    good, bad = quarantine(raw)
    assert sorted(r["id"] for r in good.collect()) == [1, 4]
    assert sorted(r[CORRUPT] for r in bad.collect()) == ["2,oops,b", "3,7,c,extra"]
    # a count reads no fields at all, yet must see the same rows
    assert (good.count(), bad.count()) == (2, 2)
    good, bad = quarantine(raw, required=["n"])
    assert (good.count(), bad.count()) == (3, 1)


def test_round_trips(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("part"))
    write_table(df, str(tmp_path / "p"), partition_by=["part"])
    back = read_table(spark, str(tmp_path / "p"), fmt="parquet")
    assert back.filter("part = 1").count() == 33
    write_table(df, str(tmp_path / "c"), fmt="csv", single_file=True)
    assert len(list((tmp_path / "c").glob("*.csv"))) == 1
    assert read_table(spark, str(tmp_path / "c")).dtypes == [("id", "int"), ("part", "int")]


def test_materialize_cuts_the_lineage(spark):
    df = materialize(spark.range(10).withColumn("x", F.col("id") * 2), "t")
    assert df.agg(F.sum("x")).first()[0] == 90
    assert "Range" not in df._jdf.queryExecution().toString()
    assert scratch_root(spark) == scratch_root(spark)


def test_no_private_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())
