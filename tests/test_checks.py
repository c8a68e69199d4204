"""Each check kind with a passing and a failing fixture; gate and severity."""

from __future__ import annotations

import pytest

from stratiform.operators.checks import (
    ERROR,
    WARN,
    Check,
    CheckFailed,
    failing_rows,
    gate,
    run_data_tests,
    run_expectations,
)


@pytest.fixture()
def df(spark):
    rows = [(2022, 1.0, 5.0, 1.0), (2022, 2.0, None, 3.0), (2022, 3.0, 7.0, 9.0), (2023, 4.0, 0.0, 55.0)]
    return spark.createDataFrame(rows, "survey_year int, state double, llcpwt double, diabete4 double")


def results(out):
    return {(r.survey_year, r.check_name): r for r in out.collect()}


def test_expectations_one_pass_per_year(df):
    suite = [
        Check("rows", "row_count_between", min_value=2, max_value=3),
        Check("has_state", "column_exists", column="state"),
        Check("has_psu", "column_exists", column="psu"),
        Check("w_nn", "not_null", column="llcpwt", mostly=0.6),
        Check("w_rng", "between", column="llcpwt", min_value=1, max_value=10, mostly=1.0),
        Check("d_set", "in_set", column="diabete4", values=(1, 2, 3, 4, 7, 9), mostly=0.6),
    ]
    r = results(run_expectations(df, suite, by=["survey_year"]))
    assert r[(2022, "rows")].passed and not r[(2023, "rows")].passed
    assert r[(2022, "has_state")].passed and not r[(2022, "has_psu")].passed
    assert r[(2022, "w_nn")].observed == pytest.approx(2 / 3) and r[(2022, "w_nn")].passed
    assert r[(2022, "w_rng")].passed and not r[(2023, "w_rng")].passed  # NULLs excluded
    assert r[(2022, "d_set")].passed and not r[(2023, "d_set")].passed


def test_gate_raises_on_error_only(df):
    bad = run_expectations(df, [Check("rows", "row_count_between", min_value=10, max_value=20)], by=["survey_year"])
    with pytest.raises(CheckFailed):
        gate(bad)
    warn = run_expectations(
        df, [Check("rows", "row_count_between", min_value=10, max_value=20, severity=WARN)], by=["survey_year"]
    )
    assert len(gate(warn)) == 2


def test_data_tests_pass_and_fail(spark):
    ok = spark.createDataFrame([(1, "Male", 25.0), (2, "Female", None)], "id int, sex string, bmi double")
    bad = spark.createDataFrame([(1, "X", 25.0), (1, None, 500.0), (None, "Male", None)], "id int, sex string, bmi double")
    suite = [
        Check("id_nn", "not_null", column="id"),
        Check("id_unique", "unique", column="id"),
        Check("sex_ok", "accepted_values", column="sex", values=("Male", "Female", "Unknown")),
        Check("bmi_ok", "expression", column="bmi", expression="bmi IS NULL OR bmi BETWEEN 10 AND 100"),
        Check("bmi_gt", "expression", column="bmi", expression="bmi > 1"),
    ]
    good = {r.test_name: r for r in run_data_tests(ok, suite, "m").collect()}
    assert all(r.passed for r in good.values())  # NULL expression result passes
    failed = {r.test_name: r.n_failures for r in run_data_tests(bad, suite, "m").collect()}
    assert failed == {"id_nn": 1, "id_unique": 1, "sex_ok": 1, "bmi_ok": 1, "bmi_gt": 0}
    assert failing_rows(bad, suite[1]).collect()[0].n_records == 2


def test_shared_pass_for_several_models(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "id int, v int")
    out = run_data_tests(df, {"a": [Check("u", "unique", column="id")], "b": [Check("u", "unique", column="id")]})
    assert sorted((r.model, r.n_failures) for r in out.collect()) == [("a", 1), ("b", 1)]
    assert ERROR == "error"


def test_global_suite_and_unique_only_tests(spark, df):
    out = run_expectations(df, [Check("rows", "row_count_between", min_value=1, max_value=10),
                                Check("w", "not_null", column="llcpwt", mostly=0.5)])
    rows = {r.check_name: r for r in out.collect()}
    assert rows["rows"].observed == 4.0 and rows["rows"].passed and rows["w"].passed
    only_unique = run_data_tests(df, [Check("u", "unique", column="survey_year")], "m").collect()
    assert only_unique[0].n_failures == 1 and not only_unique[0].passed
