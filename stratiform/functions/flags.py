"""Row-level classification flags and the composite metabolic risk score.

All of these depend only on columns of the same respondent row, so they are
added as extra columns of one enriched frame instead of separate tables
joined back on the respondent key (see ``plans.models.enrich``).

The definitions are small rule tables; three builders turn them into columns:
``first_match`` (ordered categories, an unknown test does not match),
``indicator`` (0/1, an unknown test is 0) and ``known`` (some input is given).
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Diabetes categories, thresholds and output names.
INSULIN_DEPENDENT = "Insulin-Dependent Diabetic"
DIAGNOSED = "Diagnosed Diabetic"
PREDIABETIC = "Prediabetic"
NO_DIABETES = "No Diabetes"
UNKNOWN = "Unknown"
ANALYSED_CATEGORIES = [DIAGNOSED, INSULIN_DEPENDENT, PREDIABETIC, NO_DIABETES]
HIGH_RISK_SCORE = 3
POOR_DIET_THRESHOLD = 100

#: Risk indicators that are one column's value.
VALUE_INDICATORS = {
    "obese_flag": ("bmi_category", "Obese"),
    "hypertension_flag": ("has_hypertension", True),
    "inactive_flag": ("physical_activity_index", "Inactive"),
    "no_exercise_flag": ("any_exercise_past_30d", False),
    "diabetes_flag": ("is_diagnosed_diabetic", True),
}
POOR_DIET = "poor_diet_flag"
NOT_SCORED = {"no_exercise_flag"}
SCORED_FLAGS = [f for f in (*VALUE_INDICATORS, POOR_DIET) if f not in NOT_SCORED]
#: The score is unknown only if all inputs of the scored value indicators are;
#: the diet does not count among them.
SCORE_INPUTS = [column for name, (column, _) in VALUE_INDICATORS.items() if name not in NOT_SCORED]


def first_match(rules: list[tuple[str, Column]], default: str) -> Column:
    return reduce(lambda rest, rule: F.when(rule[1], F.lit(rule[0])).otherwise(rest), reversed(rules), F.lit(default))


def indicator(test: Column) -> Column:
    return F.coalesce(test.cast("int"), F.lit(0))


def known(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])


def diabetes_flags() -> dict[str, Column]:
    """The comparisons keep unknown as NULL: either half of the prediabetes
    test may decide it, and it is NULL if neither does."""
    status = F.col("diabetes_status")
    diagnosed, insulin = status == "Diagnosed", F.col("takes_insulin") == F.lit(True)
    prediabetic = (status == "Prediabetes") | F.col("has_prediabetes")
    category = first_match(
        [(INSULIN_DEPENDENT, insulin & diagnosed), (DIAGNOSED, diagnosed), (PREDIABETIC, prediabetic), (NO_DIABETES, status == "No")],
        UNKNOWN,
    )
    return {"is_diagnosed_diabetic": diagnosed, "is_prediabetic": prediabetic, "is_insulin_dependent": insulin, "diabetes_category": category}


def risk_indicators(poor_diet_threshold: float = POOR_DIET_THRESHOLD) -> dict[str, Column]:
    out = {name: indicator(F.col(column) == F.lit(value)) for name, (column, value) in VALUE_INDICATORS.items()}
    return out | {POOR_DIET: indicator(F.col("vegetable_frequency") < poor_diet_threshold)}


def risk_score(threshold: int = HIGH_RISK_SCORE) -> dict[str, Column]:
    """The number of scored indicators, and whether it reaches the threshold;
    both unknown where the score is."""
    score = F.when(known(SCORE_INPUTS), reduce(add, map(F.col, SCORED_FLAGS)))
    return {"metabolic_risk_score": score, "high_metabolic_risk": score >= threshold}
