"""Preparation of the survey: recodes, scaling, split and sinks as one lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.columns import missing_columns, require_columns
from riskframe.functions.recode import (
    greatest_of,
    lookup,
    ordinal_levels,
    recode_binary,
    recode_ordinal,
    recode_rules,
    recode_threeway,
    replace_text,
)
from riskframe.operators.features import minmax_scale
from riskframe.operators.split import split_stratified, with_row_key
from riskframe.plans import survey_values as V
from riskframe.sources.scratch import materialize
from riskframe.sources.tables import read_table, write_table


def recode_survey(raw: DataFrame, yes_no: Sequence[str] = V.YES_NO_COLUMNS, regions: Mapping[str, str] | None = None) -> DataFrame:
    """All recodes of the raw labels.  A label outside its dictionary becomes null; columns are
    recoded once each, and a table without ``State`` gets no ``Region``."""
    regions = V.STATE_TO_REGION if regions is None else regions
    use = ordinal_levels(V.USE_LEVELS)
    smoker = recode_rules("SmokerStatus", V.SMOKER_RULES)
    ecigarette = recode_rules("ECigaretteUsage", V.ECIGARETTE_RULES)
    recoded = {c: recode_binary(c) for c in yes_no}
    recoded |= {
        "Sex": recode_binary("Sex", "Male", "Female"),
        "GeneralHealth": recode_ordinal("GeneralHealth", ordinal_levels(V.GENERAL_HEALTH_LEVELS)),
        "RemovedTeeth": recode_ordinal("RemovedTeeth", ordinal_levels(V.REMOVED_TEETH_LEVELS)),
        "AgeCategory": recode_ordinal("AgeCategory", ordinal_levels(V.AGE_LEVELS)),
        "LastCheckupTime": recode_rules("LastCheckupTime", V.CHECKUP_RULES),
        "TetanusLast10Tdap": recode_rules("TetanusLast10Tdap", V.TETANUS_RULES),
        "SmokerStatus": smoker,
        "ECigaretteUsage": ecigarette,
        "SmokerStatus_ord": recode_ordinal(smoker, use),
        "ECigaretteUsage_ord": recode_ordinal(ecigarette, use),
    }
    recoded["SmokerOrECig_ord"] = greatest_of(recoded["SmokerStatus_ord"], recoded["ECigaretteUsage_ord"])
    if not missing_columns(["State"], raw):
        recoded["Region"] = lookup("State", regions)
    require_columns(raw, [c for c in recoded if not c.endswith("_ord") and c != "Region"])
    return raw.withColumns(recoded)


def clean_survey(raw: DataFrame, scaled: Sequence[str] = V.SCALED_COLUMNS) -> DataFrame:
    return minmax_scale(recode_survey(raw), scaled)


def study_columns(clean: DataFrame) -> DataFrame:
    """The columns of the selection study: target, numeric codes and the string factors."""
    ready = clean.withColumns(
        {
            "RaceEthnicityCategory": replace_text("RaceEthnicityCategory", " ", "_"),
            "LastCheckupTime": recode_threeway("LastCheckupTime", V.CHECKUP_HIGH, V.CHECKUP_LOW),
            "TetanusLast10Tdap": recode_threeway("TetanusLast10Tdap", V.TETANUS_HIGH, V.TETANUS_LOW),
        }
    )
    columns = [*V.CONTINUOUS_COLUMNS, *V.CATEGORICAL_COLUMNS]
    strings = {c for c, t in ready.dtypes if t == "string"}
    # yes/no columns outside the recode list still hold labels
    late = {c: recode_binary(c) for c in columns if c in strings and c not in V.FACTOR_COLUMNS}
    return require_columns(ready, columns).withColumns(late).select(*columns)


def prepare_survey(
    spark: SparkSession,
    input_path: str,
    outdir: str,
    test_frac: float = 0.3,
    seed: int = 25,
    key: Sequence[str] | None = None,
    also_csv: bool = False,
) -> dict[str, str]:
    """Read, clean, split and write; returns the paths written.

    The cleaned rows are written once and the splits are filtered copies of that table, so the
    raw file is scanned for the schema, the value ranges and the cleaning only.
    """
    raw = read_table(spark, input_path)
    keyed = with_row_key(raw, key, "row_id")
    if not key:
        # the key of rows without one is a shuffle; the range scan should not repeat it
        keyed = materialize(keyed, "survey")
    paths = {part: f"{outdir.rstrip('/')}/{part}.parquet" for part in ("clean", "train", "test")}
    write_table(clean_survey(keyed), paths["clean"])
    clean = read_table(spark, paths["clean"], fmt="parquet")
    train, test = split_stratified(clean, V.TARGET, test_frac, seed, ["row_id"])
    write_table(train, paths["train"])
    write_table(test, paths["test"])
    if also_csv:
        for part, frame in (("clean", clean), ("train", train), ("test", test)):
            paths[f"{part}_csv"] = paths[part].replace(".parquet", "_csv")
            write_table(frame, paths[f"{part}_csv"], fmt="csv")
    return paths


def label_rates(split: DataFrame, y: str = V.TARGET) -> DataFrame:
    return split.groupBy(y).agg(F.count("*").alias("n"))
