"""Golden rows for decoding, flags and the risk score (FIXTURES edge rows)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stratiform.functions import codebooks as D
from stratiform.plans import models as M
from stratiform.schema import RAW_SCHEMA
from stratiform.sources.seeds import state_codes


def raw_rows(spark, rows: list[dict]):
    names = RAW_SCHEMA.fieldNames()
    data = []
    for i, r in enumerate(rows):
        base = {n: None for n in names}
        base.update({"llcpwt": 100.0, "survey_year": 2022, "state": 1.0, "loaded_at": "x"})
        base.update(r)
        data.append(tuple([i + 1] + [base[n] for n in names]))
    schema = "respondent_id bigint, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in RAW_SCHEMA.fields
    )
    return spark.createDataFrame(data, schema)


def enriched(spark, rows):
    return M.enrich(M.staging(raw_rows(spark, rows), state_codes(spark))).orderBy("respondent_id")


def test_status_unknown_for_missing_codes(spark):
    out = enriched(spark, [{"diabete4": None}, {"diabete4": 7.0}, {"diabete4": 9.0}]).collect()
    assert [r.diabetes_status for r in out] == ["Unknown"] * 3
    assert [r.is_diagnosed_diabetic for r in out] == [False] * 3


@pytest.mark.parametrize(
    "row, prediabetic, category",
    [
        ({"diabete4": 3.0, "prediab2": None}, None, "No Diabetes"),
        ({"diabete4": 3.0, "prediab2": 1.0}, True, "Prediabetic"),
        ({"diabete4": 1.0, "prediab2": 1.0, "insulin1": 1.0}, True, "Insulin-Dependent Diabetic"),
        ({"diabete4": 3.0, "prediab2": 2.0, "insulin1": 1.0}, False, "No Diabetes"),
        ({"diabete4": 2.0, "prediab2": None}, None, "Unknown"),
        ({"diabete4": 4.0, "prediab2": None}, True, "Prediabetic"),
        ({"diabete4": 1.0, "insulin1": 2.0}, None, "Diagnosed Diabetic"),
    ],
)
def test_flags_and_cascade(spark, row, prediabetic, category):
    r = enriched(spark, [row]).collect()[0]
    assert r.is_prediabetic is prediabetic
    assert r.diabetes_category == category


def test_insulin_flag(spark):
    r = enriched(spark, [{"diabete4": 3.0, "insulin1": 1.0}]).collect()[0]
    assert r.is_insulin_dependent is True and r.diabetes_category == "No Diabetes"


def test_bmi_sentinel_and_scaling(spark):
    out = enriched(spark, [{"bmi5": 9999.0}, {"bmi5": None}, {"bmi5": 2750.0}, {"bmi5": 2845.0}]).collect()
    assert [r.bmi_calc for r in out] == [None, None, 27.5, 28.5]


def test_reversed_hypertension(spark):
    out = enriched(spark, [{"rfhype6": 1.0}, {"rfhype6": 2.0}, {"rfhype6": 9.0}]).collect()
    assert [r.has_hypertension for r in out] == [False, True, None]


def test_fractional_codes_round_half_even(spark):
    out = enriched(spark, [{"sexvar": 1.9}, {"sexvar": 2.5}, {"sexvar": 1.5}, {"diabete4": 3.5}]).collect()
    assert [r.sex for r in out[:3]] == ["Female", "Female", "Female"]
    assert out[3].diabetes_status == "Prediabetes"


def test_unknown_state_code_has_no_labels(spark):
    out = enriched(spark, [{"state": 3.0}, {"state": 72.0}]).collect()
    assert (out[0].state_abbr, out[0].state_name) == (None, None)
    assert (out[1].state_abbr, out[1].state_name) == ("PR", "Puerto Rico")


def test_score_never_null_when_diabetes_flag_known(spark):
    r = enriched(spark, [{"diabete4": 1.0, "vegetab2": 99.0}]).collect()[0]
    assert r.metabolic_risk_score == 2 and r.high_metabolic_risk is False


@pytest.mark.parametrize("veg, flag", [(99.0, 1), (100.0, 0), (101.0, 0), (None, 0)])
def test_poor_diet_threshold(spark, veg, flag):
    r = enriched(spark, [{"vegetab2": veg}]).collect()[0]
    assert r.poor_diet_flag == flag


def test_score_null_branch_when_all_inputs_missing(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None, None)],
        "bmi_category string, has_hypertension boolean, physical_activity_index string, "
        "is_diagnosed_diabetic boolean, any_exercise_past_30d boolean, vegetable_frequency int",
    )
    r = M.with_risk(df).collect()[0]
    assert r.metabolic_risk_score is None and r.high_metabolic_risk is None


def test_weight_filter_drops_zero_negative_null(spark):
    rows = [{"llcpwt": 0.0}, {"llcpwt": -1.0}, {"llcpwt": None}, {"llcpwt": float("nan")}, {"llcpwt": 5.0}]
    assert enriched(spark, rows).count() == 1


def test_income_label_non_ascii(spark):
    df = spark.createDataFrame([(11.0,)], "c double")
    assert df.select(D.decode("c", D.INCOME).alias("x")).collect()[0].x == "≥$200,000"


def test_high_risk_threshold(spark):
    r = enriched(
        spark,
        [{"diabete4": 1.0, "bmi5cat": 4.0, "rfhype6": 2.0, "paindx3": 3.0}],
    ).collect()[0]
    assert r.metabolic_risk_score == 4 and r.high_metabolic_risk is True


def test_decode_columns_are_jvm_expressions(spark):
    df = spark.createDataFrame([(1.0,)], "c double")
    plan = df.select(D.decode("c", D.SEX, D.UNKNOWN).alias("s"))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert F is not None
