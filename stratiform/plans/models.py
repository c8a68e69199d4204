"""Survey models as DataFrame functions: staging, enrichment, marts, reports.

Layering follows the reference pipeline (raw -> staging -> intermediate ->
marts), but the plan shape is Spark-first:

* staging is one scan with the weight filter pushed into Parquet, one
  projection of codebook ``CASE`` expressions and a broadcast join to the
  54-row state list (fixed size);
* flags and risk depend only on the same row, so ``enrich`` adds them as
  columns instead of joining three derivations of staging on the respondent
  key (``risk_joined`` keeps the joined form as a checked alternative);
* every mart is one ``groupBy().agg()`` over the enriched frame: partial
  aggregation in each task, one small shuffle of partial rows, all estimates
  of a mart sharing that single pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.functions import codebooks as D
from stratiform.functions import estimators as E
from stratiform.functions import flags as FL
from stratiform.operators.keys import dense_row_id
from stratiform.schema import WEIGHT, YEAR

PREVALENCE_STRATA = [YEAR, "state_fips", "state_abbr", "state_name", "age_group", "race_ethnicity"]
STATE_YEAR = [YEAR, "state_fips", "state_abbr", "state_name"]
MIN_CELL = 50


def sort_nulls_last(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Ascending sort with NULLs last (the reference engine's default order)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols])


# ── staging ─────────────────────────────────────────────────────────────────
def decoded_columns(poor_diet_cols: bool = True) -> list[str]:
    """The staging projection as SQL expressions (one ``selectExpr`` call)."""
    cols = [
        YEAR,
        f"{D.code_sql('state')} AS state_fips",
        f"{D.code_sql('imonth')} AS interview_month",
        f"{D.code_sql('iyear')} AS interview_year",
        WEIGHT,
        "ststr",
        "psu",
        f"{D.decode_sql('diabete4', D.DIABETES_STATUS, D.UNKNOWN)} AS diabetes_status",
        f"{D.decode_bool_sql('prediab2')} AS has_prediabetes",
        f"{D.decode_bool_sql('insulin1')} AS takes_insulin",
        f"{D.sentinel_scaled_sql('bmi5')} AS bmi_calc",
        f"{D.decode_sql('bmi5cat', D.BMI_CATEGORY)} AS bmi_category",
        f"{D.decode_bool_sql('rfhype6', reversed_polarity=True)} AS has_hypertension",
        f"{D.decode_bool_sql('cvdcrhd4')} AS has_coronary_heart_disease",
        f"{D.decode_bool_sql('exerany2')} AS any_exercise_past_30d",
        f"{D.decode_sql('paindx3', D.PHYSICAL_ACTIVITY)} AS physical_activity_index",
        f"{D.decode_sql('sexvar', D.SEX, D.UNKNOWN)} AS sex",
        f"{D.decode_sql('ageg5yr', D.AGE_GROUP)} AS age_group",
        f"{D.decode_sql('race1', D.RACE_ETHNICITY)} AS race_ethnicity",
        f"{D.decode_sql('racegr3', D.RACE_ETHNICITY_COLLAPSED)} AS race_ethnicity_collapsed",
        f"{D.decode_sql('educa', D.EDUCATION)} AS education_level",
        f"{D.decode_sql('income3', D.INCOME)} AS income_group",
        f"{D.decode_sql('urbstat', D.URBAN_RURAL)} AS urban_rural",
    ]
    if poor_diet_cols:
        cols += [
            f"{D.code_sql('fruit2')} AS fruit_frequency",
            f"{D.code_sql('fruitju2')} AS fruit_juice_frequency",
            f"{D.code_apart_sql('vegetab2')} AS vegetable_frequency",
        ]
    return cols


def staging(
    raw: DataFrame,
    states: DataFrame,
    key: str = "respondent_id",
    key_order: list[str] | None = None,
) -> DataFrame:
    """Decoded respondents with positive weight, state labels and a unique key.

    ``key`` is kept when the raw table carries it (a natural or file-ordinal
    key); otherwise ``dense_row_id`` numbers the rows 1..N in ``key_order``
    (which must be a total order) without a single-partition window.
    ``states`` is a small lookup; its known size decides about a broadcast.
    """
    has_key = key in raw.columns
    if not has_key and not key_order:
        raise ValueError("raw table has no key column; pass key_order (a unique total order)")
    carried = [key] if has_key else [c for c in key_order if c not in STAGED_COLUMNS]
    # NaN > 0 is true in Spark: drop NaN weights too (ingest already maps NaN to NULL)
    kept = raw.where((F.col(WEIGHT) > F.lit(0.0)) & ~F.isnan(F.col(WEIGHT)))
    decoded = kept.selectExpr(*carried, *decoded_columns())
    lookup = states.select("fips_code", "state_abbr", "state_name")
    joined = decoded.join(lookup, F.col("state_fips") == F.col("fips_code"), "left").drop("fips_code")
    if not has_key:
        joined = dense_row_id(joined, key_order, id_col=key)
    return joined.select(F.col(key).alias("respondent_id"), *STAGED_COLUMNS, "state_abbr", "state_name")


STAGED_COLUMNS = [
    YEAR, "state_fips", "interview_month", "interview_year", WEIGHT, "ststr", "psu",
    "diabetes_status", "has_prediabetes", "takes_insulin", "bmi_calc", "bmi_category",
    "has_hypertension", "has_coronary_heart_disease", "any_exercise_past_30d",
    "physical_activity_index", "sex", "age_group", "race_ethnicity", "race_ethnicity_collapsed",
    "education_level", "income_group", "urban_rural",
    "fruit_frequency", "fruit_juice_frequency", "vegetable_frequency",
]


# ── intermediate ────────────────────────────────────────────────────────────
def with_diabetes_flags(staged: DataFrame) -> DataFrame:
    return staged.withColumns(FL.diabetes_flags())


def with_risk(
    flagged: DataFrame,
    poor_diet_threshold: float = FL.POOR_DIET_THRESHOLD,
    high_risk_score: int = FL.HIGH_RISK_SCORE,
) -> DataFrame:
    out = flagged.withColumns(FL.risk_indicators(poor_diet_threshold))
    return out.withColumns(FL.risk_score(high_risk_score))


def enrich(staged: DataFrame, poor_diet_threshold: float = FL.POOR_DIET_THRESHOLD) -> DataFrame:
    """Staging + diabetes flags + risk columns, all row-local (no join)."""
    return with_risk(with_diabetes_flags(staged), poor_diet_threshold)


FLAG_COLUMNS = ["respondent_id", YEAR, WEIGHT, "is_diagnosed_diabetic", "is_prediabetic",
                "is_insulin_dependent", "diabetes_category"]
RISK_COLUMNS = ["respondent_id", YEAR, WEIGHT, "obese_flag", "hypertension_flag", "inactive_flag",
                "no_exercise_flag", "diabetes_flag", "poor_diet_flag", "metabolic_risk_score",
                "high_metabolic_risk"]


def diabetes_flags(staged: DataFrame) -> DataFrame:
    """The diabetes-flags model (7 columns)."""
    return with_diabetes_flags(staged).select(*FLAG_COLUMNS)


def metabolic_risk(staged: DataFrame) -> DataFrame:
    """The metabolic-risk model (11 columns), row-local plan."""
    return enrich(staged).select(*RISK_COLUMNS)


def metabolic_risk_joined(staged: DataFrame) -> DataFrame:
    """The same model as a left join of staging to the flags model on the key.

    Kept to check that the row-local plan equals the joined one; it costs a
    shuffle of both sides on ``respondent_id``.
    """
    flags = diabetes_flags(staged).select("respondent_id", "is_diagnosed_diabetic")
    base = staged.select("respondent_id", YEAR, WEIGHT, "bmi_category", "has_hypertension",
                         "physical_activity_index", "any_exercise_past_30d", "vegetable_frequency")
    return with_risk(base.join(flags, on="respondent_id", how="left")).select(*RISK_COLUMNS)


# ── marts ───────────────────────────────────────────────────────────────────
DIM_COLUMNS = ["respondent_id", YEAR, "state_fips", "state_abbr", "state_name", "interview_month",
               "interview_year", "sex", "age_group", "race_ethnicity", "race_ethnicity_collapsed",
               "education_level", "income_group", "urban_rural"]


def dim_demographics(staged: DataFrame) -> DataFrame:
    return staged.select(*DIM_COLUMNS)


def prevalence(
    enriched: DataFrame,
    strata: list[str] = PREVALENCE_STRATA,
    min_cell: int = MIN_CELL,
    sort: bool = True,
) -> DataFrame:
    """Diabetes prevalence by strata with small-cell suppression.

    Rows with an unknown age group or collapsed race are out of the domain.
    Suppression masks the three prevalence columns where ``unweighted_n <
    min_cell``; counts and weighted totals stay, and no row is dropped.
    """
    needed = [
        "race_ethnicity_collapsed AS race_ethnicity" if c == "race_ethnicity" else c for c in strata
    ] + [WEIGHT, "is_diagnosed_diabetic", "is_prediabetic", "is_insulin_dependent"]
    base = enriched.where("age_group IS NOT NULL AND race_ethnicity_collapsed IS NOT NULL").selectExpr(*needed)
    diagnosed = "is_diagnosed_diabetic = true"
    agg = base.groupBy(*strata).agg(
        E.weighted_proportion(diagnosed).alias("weighted_diabetes_prevalence"),
        E.weighted_proportion("is_prediabetic = true").alias("weighted_prediabetes_prevalence"),
        E.weighted_proportion("is_insulin_dependent = true").alias("weighted_insulin_dependent_prevalence"),
        E.weighted_count(diagnosed).alias("weighted_n_diabetic"),
        E.weighted_total().alias("weighted_n_total"),
        E.count_rows().alias("unweighted_n"),
        E.conditional_count(diagnosed).alias("unweighted_n_diabetic"),
    )
    out = agg.select(
        *strata,
        "unweighted_n",
        "unweighted_n_diabetic",
        "weighted_n_total",
        "weighted_n_diabetic",
        *[
            E.suppress(c, "unweighted_n", min_cell).alias(c)
            for c in (
                "weighted_diabetes_prevalence",
                "weighted_prediabetes_prevalence",
                "weighted_insulin_dependent_prevalence",
            )
        ],
    )
    if not sort:
        return out
    order = [c for c in (YEAR, "state_abbr", "age_group", "race_ethnicity") if c in strata] or strata
    return sort_nulls_last(out, *order)


def risk_factors(enriched: DataFrame, sort: bool = True) -> DataFrame:
    """Risk-factor prevalence by diabetes category and year (wide)."""
    base = enriched.where(F.col("diabetes_category").isin(FL.ANALYSED_CATEGORIES))
    wp = E.weighted_proportion
    out = base.groupBy(YEAR, "diabetes_category").agg(
        E.count_rows().alias("unweighted_n"),
        E.weighted_total().alias("weighted_n"),
        wp("obese_flag = 1").alias("pct_obese"),
        wp("hypertension_flag = 1").alias("pct_hypertensive"),
        wp("inactive_flag = 1").alias("pct_inactive"),
        wp("no_exercise_flag = 1").alias("pct_no_exercise"),
        wp("poor_diet_flag = 1").alias("pct_poor_diet"),
        wp("high_metabolic_risk = true").alias("pct_high_metabolic_risk"),
        E.weighted_mean("metabolic_risk_score").alias("mean_metabolic_risk_score"),
    )
    return sort_nulls_last(out, YEAR, "diabetes_category") if sort else out


def risk_factors_joined(staged: DataFrame, sort: bool = True) -> DataFrame:
    """The risk-factor mart in the reference's join form: staging left-joined
    to the flags model and to the risk model on the respondent key, filtered
    on a right-side column.  The filter makes both outer joins inner
    (Catalyst rewrites them); both joins hash-partition on the same key, so
    each side is shuffled once.  ``risk_factors(enrich(staged))`` gives the
    same rows without any join.
    """
    flags = diabetes_flags(staged).select("respondent_id", "diabetes_category")
    risk = metabolic_risk(staged).drop(YEAR, WEIGHT)
    base = (
        staged.select("respondent_id", YEAR, WEIGHT)
        .join(flags, on="respondent_id", how="left")
        .join(risk, on="respondent_id", how="left")
    )
    return risk_factors(base, sort=sort)


def state_year_estimates(enriched: DataFrame, sort: bool = True) -> DataFrame:
    """Ten weighted outcome proportions per state and year (wide)."""
    wp = E.weighted_proportion
    out = enriched.groupBy(*STATE_YEAR).agg(
        E.count_rows().alias("unweighted_n"),
        E.weighted_total().alias("estimated_adult_population"),
        wp("is_diagnosed_diabetic = true").alias("pct_diagnosed_diabetic"),
        wp("is_prediabetic = true").alias("pct_prediabetic"),
        wp("is_insulin_dependent = true").alias("pct_insulin_dependent"),
        wp("bmi_category = 'Obese'").alias("pct_obese"),
        wp("bmi_category IN ('Overweight', 'Obese')").alias("pct_overweight_or_obese"),
        wp("has_hypertension = true").alias("pct_hypertensive"),
        wp("has_coronary_heart_disease = true").alias("pct_coronary_heart_disease"),
        wp("any_exercise_past_30d = true").alias("pct_any_exercise"),
        wp("physical_activity_index = 'Inactive'").alias("pct_inactive"),
        wp("high_metabolic_risk = true").alias("pct_high_metabolic_risk"),
    )
    return sort_nulls_last(out, YEAR, "state_abbr") if sort else out


# ── reports over the prevalence mart ────────────────────────────────────────
def trend_by_group(prev: DataFrame, group: str = "race_ethnicity") -> DataFrame:
    """Unsuppressed cells re-aggregated to year x group, percent to 1 dp."""
    kept = prev.where(F.col("weighted_diabetes_prevalence").isNotNull())
    out = kept.groupBy(YEAR, group).agg(
        E.percent(E.safe_ratio(F.sum("weighted_n_diabetic"), F.sum("weighted_n_total")), 1).alias("diabetes_pct"),
        F.sum("unweighted_n").cast("bigint").alias("n_respondents"),
    )
    return out.orderBy(F.col(YEAR).asc_nulls_last(), F.col("diabetes_pct").desc_nulls_last())


def national_prevalence(prev: DataFrame) -> DataFrame:
    """Yearly national prevalence from a mart; suppressed cells excluded by a
    conditional sum (numerator) and a NULL-skipping sum (denominator)."""
    unsuppressed = F.col("weighted_diabetes_prevalence").isNotNull()
    return prev.groupBy(YEAR).agg(
        E.safe_ratio(
            F.sum(F.when(unsuppressed, F.col("weighted_n_diabetic")).otherwise(F.lit(0.0))),
            F.sum(F.when(unsuppressed, F.col("weighted_n_total"))),
        ).alias("national_weighted_prevalence")
    )


def national_prevalence_pct(prev: DataFrame) -> DataFrame:
    """Filter form of the same re-aggregation, in percent (2 dp) with counts."""
    kept = prev.where(F.col("weighted_diabetes_prevalence").isNotNull())
    out = kept.groupBy(YEAR).agg(
        E.percent(E.safe_ratio(F.sum("weighted_n_diabetic"), F.sum("weighted_n_total")), 2).alias(
            "national_prevalence_pct"
        ),
        F.sum("unweighted_n").cast("bigint").alias("n_respondents"),
    )
    return sort_nulls_last(out, YEAR)


def prevalence_outside(prev: DataFrame, low: float, high: float) -> DataFrame:
    """Years whose national prevalence leaves the plausible range (Q15)."""
    national = national_prevalence(prev).where(~F.col("national_weighted_prevalence").between(low, high))
    return national.select(YEAR, E.percent("national_weighted_prevalence", 2).alias("prevalence_pct"))


def weights_outside(staged: DataFrame, low: float, high: float) -> DataFrame:
    """Years whose weights do not add up to a plausible population (Q14)."""
    totals = staged.groupBy(YEAR).agg(F.sum(WEIGHT).alias("_w"), E.count_rows().alias("n_respondents"))
    totals = totals.where(~F.col("_w").between(low, high))
    return totals.select(YEAR, E.millions("_w", 1).alias("total_weight_millions"), "n_respondents")


def rows_by_year(df: DataFrame) -> DataFrame:
    return sort_nulls_last(df.groupBy(YEAR).agg(E.count_rows().alias("n_rows")), YEAR)


def weight_millions(staged: DataFrame) -> DataFrame:
    out = staged.groupBy(YEAR).agg(
        E.millions(E.weighted_total(), 1).alias("total_weight_millions"),
        E.count_rows().alias("n_respondents"),
    )
    return sort_nulls_last(out, YEAR)
