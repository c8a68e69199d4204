"""The check suites of the pipeline: raw expectations and model data tests."""

from __future__ import annotations

from stratiform.operators.checks import ERROR, WARN, Check
from stratiform.schema import RAW_VARIABLES, WEIGHT, YEAR

# Raw-gate thresholds.
MIN_ROWS_PER_YEAR = 400_000
MAX_ROWS_PER_YEAR = 600_000
WEIGHT_MAX = 100_000_000
STATE_RANGE = (1, 78)
DIABETES_CODES = (1, 2, 3, 4, 7, 9)
DEFAULT_YEARS = (2021, 2022, 2023)
WEIGHT_POPULATION_RANGE = (200e6, 280e6)  # sum of a year's weights
PREVALENCE_RANGE = (0.08, 0.15)  # national prevalence of a year


def raw_expectations(
    years: tuple[int, ...] = DEFAULT_YEARS,
    min_rows: int = MIN_ROWS_PER_YEAR,
    max_rows: int = MAX_ROWS_PER_YEAR,
) -> list[Check]:
    """The raw suite (31 checks per year with the 25 kept variables)."""
    checks = [Check("row_count_between", "row_count_between", min_value=min_rows, max_value=max_rows)]
    checks += [Check(f"column_exists_{c}", "column_exists", column=c) for c in RAW_VARIABLES]
    checks += [
        Check("weight_not_null", "not_null", column=WEIGHT, mostly=0.99),
        Check("weight_between", "between", column=WEIGHT, min_value=0, max_value=WEIGHT_MAX, mostly=0.99),
        Check("state_between", "between", column="state", min_value=STATE_RANGE[0], max_value=STATE_RANGE[1],
              mostly=0.99),
        Check("survey_year_in_set", "in_set", column=YEAR, values=tuple(years)),
        Check("diabete4_in_set", "in_set", column="diabete4", values=DIABETES_CODES, mostly=0.95),
    ]
    return checks


DIABETES_STATUSES = ("Diagnosed", "Gestational Only", "No", "Prediabetes", "Unknown")
SEXES = ("Male", "Female", "Unknown")


def staging_tests(years: tuple[int, ...] = DEFAULT_YEARS) -> list[Check]:
    return [
        Check("respondent_id_unique", "unique", column="respondent_id", severity=WARN),
        Check("respondent_id_not_null", "not_null", column="respondent_id", severity=WARN),
        Check("survey_year_not_null", "not_null", column=YEAR, severity=WARN),
        Check("survey_year_accepted", "accepted_values", column=YEAR, values=tuple(years), severity=WARN),
        Check("state_fips_not_null", "not_null", column="state_fips", severity=WARN),
        Check("state_fips_range", "expression", column="state_fips",
              expression="state_fips BETWEEN 1 AND 78", severity=WARN),
        Check("llcpwt_not_null", "not_null", column=WEIGHT, severity=WARN),
        Check("llcpwt_positive", "expression", column=WEIGHT, expression="llcpwt > 0", severity=WARN),
        Check("bmi_calc_plausible", "expression", column="bmi_calc",
              expression="bmi_calc IS NULL OR bmi_calc BETWEEN 10.0 AND 100.0", severity=WARN),
        Check("diabetes_status_not_null", "not_null", column="diabetes_status", severity=WARN),
        Check("diabetes_status_accepted", "accepted_values", column="diabetes_status",
              values=DIABETES_STATUSES, severity=WARN),
        Check("sex_accepted", "accepted_values", column="sex", values=SEXES, severity=WARN),
    ]


def flags_tests() -> list[Check]:
    return [
        Check("respondent_id_not_null", "not_null", column="respondent_id", severity=WARN),
        Check("respondent_id_unique", "unique", column="respondent_id", severity=WARN),
    ]


def risk_tests() -> list[Check]:
    return [
        Check("respondent_id_not_null", "not_null", column="respondent_id", severity=WARN),
        Check("respondent_id_unique", "unique", column="respondent_id", severity=WARN),
        Check("score_range", "expression", column="metabolic_risk_score",
              expression="metabolic_risk_score IS NULL OR metabolic_risk_score BETWEEN 0 AND 5", severity=WARN),
    ]


def prevalence_tests() -> list[Check]:
    return [
        Check("survey_year_not_null", "not_null", column=YEAR, severity=WARN),
        Check("state_fips_not_null", "not_null", column="state_fips", severity=WARN),
        Check("prevalence_range", "expression", column="weighted_diabetes_prevalence",
              expression="weighted_diabetes_prevalence IS NULL OR weighted_diabetes_prevalence BETWEEN 0 AND 1",
              severity=WARN),
        Check("unweighted_n_positive", "expression", column="unweighted_n", expression="unweighted_n > 0",
              severity=WARN),
    ]


# Generic suites over the driver's events table (checks are not survey-specific).
EVENT_TYPES = ("view", "click", "purchase", "signup", "error")


def events_expectations() -> list[Check]:
    return [
        Check("row_count_between", "row_count_between", min_value=1_000, max_value=1_000_000),
        Check("column_exists_value", "column_exists", column="value"),
        Check("column_exists_amount", "column_exists", column="amount"),
        Check("value_not_null", "not_null", column="value", mostly=0.99),
        Check("value_between", "between", column="value", min_value=0, max_value=250, mostly=0.5),
        Check("user_id_in_range", "between", column="user_id", min_value=0, max_value=1000, mostly=0.9),
    ]


def events_tests() -> list[Check]:
    return [
        Check("event_id_unique", "unique", column="event_id", severity=WARN),
        Check("event_id_not_null", "not_null", column="event_id", severity=WARN),
        Check("event_type_accepted", "accepted_values", column="event_type", values=EVENT_TYPES[:4], severity=WARN),
        Check("value_positive", "expression", column="value", expression="value > 1", severity=WARN),
    ]


__all__ = ["ERROR", "WARN", "raw_expectations", "staging_tests", "flags_tests", "risk_tests", "prevalence_tests"]
