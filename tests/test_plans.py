import itertools

import pytest
from pyspark.sql import functions as F

from riskframe.functions.keys import hash_unit
from riskframe.functions.recode import recode_binary, recode_rules
from riskframe.operators.linear import glm_logit
from riskframe.operators.metrics import classification_report, confusion, roc_curve
from riskframe.plans import survey as S
from riskframe.plans import survey_values as V
from riskframe.plans.segments import segment_risk
from riskframe.plans.selection import select_features
from riskframe.streaming import each


def respondents(n):
    """Rows that walk through all labels of every survey column."""
    checkup = [
        "Within past year (anytime less than 12 months ago)", "Within past 2 years (1 year but less than 2 years ago)",
        "Within past 5 years (2 years but less than 5 years ago)", "5 or more years ago",
    ]
    tetanus = [
        "No, did not receive any tetanus shot in the past 10 years", "Yes, received Tdap",
        "Yes, received tetanus shot, but not Tdap", "Yes, received tetanus shot but not sure what type",
    ]
    smoker = ["Never smoked", "Former smoker", "Current smoker - now smokes some days", "Current smoker - now smokes every day"]
    ecig = [
        "Never used e-cigarettes in my entire life", "Not at all (right now)", "Use them some days", "Use them every day",
    ]
    states = [*V.STATE_TO_REGION, "Guam"]
    pick = lambda values, i, step=1: values[(i // step) % len(values)]
    rows = []
    for i in range(n):
        row = {c: pick(["Yes", "No"], i * 7 + k, k + 1) for k, c in enumerate(V.YES_NO_COLUMNS)}
        row |= {
            "HadSkinCancer": pick(["No", "Yes"], i, 3), "PhysicalActivities": pick(["Yes", "No"], i, 5),
            "State": pick(states, i), "Sex": pick(["Female", "Male"], i, 2), "GeneralHealth": pick(V.GENERAL_HEALTH_LEVELS, i),
            "RemovedTeeth": pick(V.REMOVED_TEETH_LEVELS, i), "AgeCategory": pick(V.AGE_LEVELS, i),
            "LastCheckupTime": pick(checkup, i), "TetanusLast10Tdap": pick(tetanus, i, 3), "SmokerStatus": pick(smoker, i, 2),
            "ECigaretteUsage": pick(ecig, i, 5), "HadDiabetes": pick(["No", "Yes", "Other"], i),
            "CovidPos": pick(["No", "Yes", "Home Test"], i, 4), "RaceEthnicityCategory": pick(["Black only", "White only"], i, 7),
            "PhysicalHealthDays": i % 31, "MentalHealthDays": i % 17, "SleepHours": i % 12 + 1,
            "HeightInMeters": 1.5 + i % 40 / 100, "WeightInKilograms": 50.0 + i % 60, "BMI": 18.0 + i % 23,
        }
        rows.append(row)
    return rows


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(respondents(212))


def test_survey_recodes(raw):
    out = S.clean_survey(raw).cache()
    first = out.filter("State = 'Maine'").first()
    assert first["Region"] == "New_England" and first["GeneralHealth"] == 1 and first["LastCheckupTime"] == "Within past year"
    assert out.filter("State = 'Guam' and Region is null").count() == out.filter("State = 'Guam'").count() > 0
    kinds = dict(out.dtypes)
    assert all(kinds[c] == "int" for c in [*V.YES_NO_COLUMNS, "Sex", "AgeCategory", "SmokerOrECig_ord"])
    assert {r[0] for r in out.select("TetanusLast10Tdap").distinct().collect()} == {"No", "Yes-Tdap", "Yes-not Tdap", "Yes-type unknown"}
    assert {r[0] for r in out.select("LastCheckupTime").distinct().collect()} == {"Within past year", "Within past 2 years", "Over 2 years ago"}
    assert out.filter("SmokerOrECig_ord != greatest(SmokerStatus_ord, ECigaretteUsage_ord)").count() == 0
    low, high = out.agg(F.min("BMI_scaled"), F.max("BMI_scaled")).first()
    assert (low, high) == (0.0, 1.0) and len(V.STATE_TO_REGION) == 52
    study = S.study_columns(out)
    assert len(study.columns) == 39 and dict(study.dtypes)["HadSkinCancer"] == "int"
    assert {r[0] for r in study.select("LastCheckupTime").distinct().collect()} == {0, 1, 2}
    assert "White_only" in {r[0] for r in study.select("RaceEthnicityCategory").distinct().collect()}


def test_missing_survey_column_is_named(raw):
    with pytest.raises(ValueError, match="BMI"):
        S.clean_survey(raw.drop("BMI"))
    with pytest.raises(ValueError, match="AgeCategory"):
        S.recode_survey(raw.drop("AgeCategory"))
    assert "Region" not in S.recode_survey(raw.drop("State")).columns


def test_survey_files(spark, raw, tmp_path):
    raw.coalesce(1).write.option("header", True).csv(str(tmp_path / "in"))
    runs = []
    for out in ("a", "b"):
        paths = S.prepare_survey(spark, str(tmp_path / "in"), str(tmp_path / out), also_csv=out == "a")
        clean, train, test = (spark.read.parquet(paths[p]) for p in ("clean", "train", "test"))
        assert clean.count() == 212 == train.count() + test.count()
        assert train.join(test, "row_id").count() == 0 and 30 < test.count() < 95
        runs.append({r["row_id"] for r in test.collect()})
    assert runs[0] == runs[1]
    assert spark.read.option("header", True).csv(str(tmp_path / "a" / "test_csv")).count() == len(runs[0])
    assert sum(r["n"] for r in S.label_rates(train).collect()) == train.count()


@pytest.fixture(scope="module")
def cohort(spark):
    u = [hash_unit(["id"], s) for s in range(5)]
    return spark.range(800).select(
        (u[0] * 4).alias("a"), (u[1] * 2).alias("b"), F.when(u[2] < 0.3, "x y").when(u[2] < 0.7, "z,w").otherwise("k").alias("f"),
        (u[0] * 4 + F.when(u[2] < 0.3, 2).otherwise(0) + u[3] * 3 > 4).cast("int").alias("y"),
    ).cache()


def test_selection_gives_the_significant_table(cohort):
    got = select_features(cohort, "y", ["a", "b", "f"], ["f"])
    assert got.table.columns == [*got.names, "y"] and "a" in got.names and "b" not in got.names
    assert all(p <= 0.1 for n, _, _, _, p in got.stepwise.fit.rows() if n in got.names)
    assert got.stepwise.path[0][5] == pytest.approx(got.full.stats["aic"])
    assert got.table.count() == 800


def test_segments(cohort):
    out = segment_risk(cohort, "y", ["a", "b"], k=3)
    assert out.rows.columns == [*cohort.columns, "cluster"] and out.rows.count() == 800
    assert sorted(out.importance.columns) == sorted(["feature", *[f"cluster_{i}" for i in out.models.fits]])
    sizes = {r["cluster"]: r["n"] for r in out.rows.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    modelled = {g for g, fit in out.models.fits.items() if fit is not None}
    found = {r["cluster"]: r for r in out.report.filter("label = 'accuracy'").collect()}
    assert {c: r["support"] for c, r in found.items()} == sizes
    unjudged = {r["cluster"] for r in out.report.filter("label = 'null'").collect()}
    assert unjudged == set(sizes) - modelled and all(found[c]["f1"] == 0 for c in unjudged)
    assert out.rmse.count() == len(sizes)


def test_metrics_against_hand_counts(spark):
    rows = [(1, 0.9), (1, 0.9), (0, 0.9), (1, 0.6), (0, 0.6), (0, 0.2), (0, 0.1), (0, 0.1)]
    df = spark.createDataFrame(rows, "y int, prob double").withColumn("pred", (F.col("prob") > 0.58).cast("int"))
    cells = {(r["actual"], r["predicted"]): r["n"] for r in confusion(df).collect()}
    assert cells == {(0, 0): 3, (0, 1): 2, (1, 0): 0, (1, 1): 3}
    report = {r["label"]: r for r in classification_report(df).collect()}
    assert report["1"]["precision"] == 0.6 and report["1"]["recall"] == 1.0 and report["accuracy"]["f1"] == 0.75
    for keep, drop in itertools.product((True, False), (True, False)):
        scores = df if keep else df.filter("y = 0")
        want = []
        for t in sorted({p for y, p in rows if keep or y == 0}, reverse=True):
            hit = [y for y, p in rows if p >= t and (keep or y == 0)]
            want.append((t, hit.count(0) / 5, hit.count(1) / 3 if keep else None))
        got = [tuple(r) for r in roc_curve(scores, drop_collinear=drop).orderBy(F.col("threshold").desc()).collect()]
        if not drop:
            assert got[1:] == want and got[0][1] == 0.0
        elif keep:
            assert got[1:] == want  # no three points in line with equal steps
        else:
            assert [g[0] for g in got] == [float("inf"), 0.9, 0.2, 0.1]


def test_recodes_and_scores_run_on_a_stream(spark, cohort, tmp_path):
    source = str(tmp_path / "rows")
    cohort.write.parquet(source)
    fit = glm_logit(cohort, "y", ["a", "b"])
    steps = each(
        lambda d: d.withColumns({"flag": recode_binary("f", "k", "x y"), "kind": recode_rules("f", [("contains", ",", "comma")])}),
        fit.score,
    )
    stream = spark.readStream.schema(cohort.schema).parquet(source).transform(steps)
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    assert query.awaitTermination(60)
    got, want = spark.read.parquet(str(tmp_path / "out")), steps(cohort)
    assert got.count() == 800 and got.exceptAll(want.select(got.columns)).count() == 0


def test_rows_without_a_label_are_no_silent_loss(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (None, 1), (1, None)], "y int, pred int")
    with pytest.raises(Exception, match="null in"):
        confusion(df).collect()
    told = {(r.actual, r.predicted): r.n for r in confusion(df, nulls="label").collect()}
    assert sum(told.values()) == 4 and told["null", "1"] == 1 and told["1", "null"] == 1 and len(told) == 9
    support = {r.label: r.support for r in classification_report(df, nulls="label").collect()}
    assert support["accuracy"] == 4
