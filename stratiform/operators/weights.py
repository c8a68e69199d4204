"""Weight diagnostics: per-group totals attached to rows, normalisation, flags.

The per-year totals are a pre-aggregate (partial + final hash aggregate: one
row per year leaves each task) joined back to the rows; adaptive execution sees how
small the totals are and broadcasts them, so the detail side need not shuffle.  A ``Window.partitionBy(year)`` would instead shuffle every row
into as many tasks as there are years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.operators.joins import null_safe
from stratiform.schema import WEIGHT, YEAR

EXTREME_WEIGHT_FACTOR = 20


def group_totals(df: DataFrame, by: list[str], weight: str = WEIGHT) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_respondents"),
        F.sum(F.col(weight)).alias("total_weight"),
    )


def attach_group_totals(
    df: DataFrame,
    by: list[str],
    weight: str = WEIGHT,
) -> DataFrame:
    """Each row with its group's count and weight total; NULL is a group."""
    return null_safe(df, group_totals(df, by, weight), by)


def survey_weights(
    staged: DataFrame,
    by: list[str] | None = None,
    weight: str = WEIGHT,
    extreme_factor: float = EXTREME_WEIGHT_FACTOR,
) -> DataFrame:
    """Normalised weights (sum to n within each year) and an extreme-weight flag."""
    by = by or [YEAR]
    base = staged.select(
        "respondent_id", YEAR, "state_fips", "state_abbr", weight, "ststr", "psu",
        *[c for c in by if c not in (YEAR, "state_fips", "state_abbr")],
    )
    joined = attach_group_totals(base, by, weight)
    return joined.select(
        "respondent_id",
        YEAR,
        "state_fips",
        "state_abbr",
        weight,
        "ststr",
        "psu",
        (F.col(weight) / F.col("total_weight") * F.col("n_respondents")).alias("normalized_weight"),
        F.col("n_respondents").alias("year_n_respondents"),
        F.col("total_weight").alias("year_total_weight"),
        (F.col(weight) > F.col("total_weight") / F.col("n_respondents") * F.lit(float(extreme_factor))).alias(
            "is_extreme_weight"
        ),
    )
