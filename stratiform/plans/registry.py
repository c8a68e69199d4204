"""Registered queries (Spark) and their oracle SQL (DuckDB), keyed alike.

Every query reads the driver tables under ``sf_dir`` (or data Spark derives
from them) in full.  Survey models run on the raw respondent frame derived
from ``orders`` (see ``plans.frame``).  Column names and types are aligned
with the oracle: counts BIGINT, weighted sums DOUBLE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.functions import codebooks as D
from stratiform.functions import estimators as E
from stratiform.operators.checks import run_data_tests, run_expectations
from stratiform.operators.keys import dense_row_id
from stratiform.operators.quantile import percentile_cont_by, percentiles_cont, winsorize
from stratiform.operators.weights import survey_weights
from stratiform.plans import models as M
from stratiform.plans.frame import raw_frame, read_table
from stratiform.plans import suites as S
from stratiform.plans.oracle import DECODED_SELECT, prevalence_sql, shares, with_survey
from stratiform.schema import WEIGHT, YEAR
from stratiform.sources.ingest import project_allowlist, unify_years
from stratiform.sources import landing
from stratiform.sources.seeds import state_codes

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered driver queries.
DISCOUNT_CUT = 0.05
HIGH_VALUE_CUT = 100.0
LINEITEM_YEAR_RANGE = (200_000.0, 250_000.0)
WEIGHT_POPULATION_RANGE = S.WEIGHT_POPULATION_RANGE
PREVALENCE_RANGE = S.PREVALENCE_RANGE
TREND_MIN_CELL = 20
PERCENTILES = (0.5, 0.9, 0.99)
WINSOR_P = 0.99
DROPPED_YEAR = 2022  # the yearly file that lacks prediab2 in ``union_years``
DROPPED_COLUMN, ABSENT_YEAR = "diabete4", 2099  # for ``check_requested_years``
EXTREME_FACTOR = 1.5  # met by some weights of the derived frame, not by all
NARROW_RANGE = (0.115, 0.119)  # one year meets it
NULL_GROUPS_SQL = "SELECT event_id, value, CASE WHEN event_id % 7 <> 0 THEN event_type END AS grp FROM events"


# ── shared builders ─────────────────────────────────────────────────────────
def staged(spark: SparkSession, sf: str) -> DataFrame:
    return M.staging(raw_frame(spark, sf), state_codes(spark))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return M.enrich(staged(spark, sf))


def _ship_year() -> F.Column:
    return F.year("l_shipdate").cast("int").alias("ship_year")


def _doc_labels(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    labels = read_table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, on="doc_id", how="left").withColumn("w", F.col("n_chars").cast("double"))


# ── generic estimators on driver tables ─────────────────────────────────────
def q_weighted_proportion(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus", _ship_year()).agg(
        E.count_rows().alias("n_rows"),
        E.weighted_total("l_quantity").alias("weighted_n"),
        E.weighted_proportion(F.col("l_discount") > DISCOUNT_CUT, "l_quantity").alias("prop_discounted"),
    )


def q_weighted_count(spark, sf):
    li = read_table(spark, sf, "lineitem")
    cond = F.col("l_discount") > DISCOUNT_CUT
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        E.count_rows().alias("n_rows"),
        E.conditional_count(cond).alias("n_discounted"),
        E.weighted_count(cond, "l_quantity").alias("weighted_n_discounted"),
        E.weighted_total("l_quantity").alias("weighted_n"),
    )


def q_weighted_proportion_null_outcome(spark, sf):
    return _doc_labels(spark, sf).groupBy("lang").agg(
        E.count_rows().alias("n_docs"),
        E.weighted_total("w").alias("weighted_n"),
        E.weighted_proportion(F.col("quality") == 1, "w").alias("prop_quality"),
        E.weighted_proportion(F.col("toxic") == 1, "w").alias("prop_toxic"),
    )


def q_weighted_mean_null_aware(spark, sf):
    return _doc_labels(spark, sf).groupBy("lang").agg(
        E.weighted_mean("quality", "w").alias("mean_quality"),
        E.safe_ratio(F.sum(F.col("quality") * F.col("w")), F.sum("w")).alias("mean_quality_all_weights"),
        E.weighted_mean("toxic", "w").alias("mean_toxic"),
    )


def q_unweighted_proportion(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.groupBy("event_type").agg(
        E.count_rows().alias("n_events"),
        E.unweighted_proportion(F.col("value") > HIGH_VALUE_CUT).alias("share_high_value"),
    )


def q_conditional_count(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.groupBy("event_type").agg(
        E.count_rows().alias("n_events"),
        E.conditional_count(F.col("value") > HIGH_VALUE_CUT).alias("n_high_value"),
    )


def q_having_weight_range(spark, sf):
    li = read_table(spark, sf, "lineitem")
    lo, hi = LINEITEM_YEAR_RANGE
    agg = li.groupBy(_ship_year()).agg(
        F.sum("l_quantity").alias("_w"),
        E.count_rows().alias("n_rows"),
    )
    return agg.where(~F.col("_w").between(lo, hi)).select(
        "ship_year", E.millions("_w", 1).alias("total_weight_millions"), "n_rows"
    )


def q_positive_weight_filter(spark, sf):
    cust = read_table(spark, sf, "customer")
    return cust.where(F.col("c_acctbal") > 0).select("c_custkey", "c_nationkey", "c_acctbal")


def q_dense_row_id(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return dense_row_id(orders, ["o_orderkey"], id_col="row_id").select("o_orderkey", "o_custkey", "row_id")


def q_percentile(spark, sf):
    ev = read_table(spark, sf, "events")
    vals = percentiles_cont(ev, "value", list(PERCENTILES))
    names = [f"p{int(round(p * 100))}" for p in PERCENTILES]
    # one row built JVM-side from the two-per-percentile values fetched
    return spark.range(1).select(
        *[F.lit(None if v is None else round(v, 6)).cast("double").alias(n) for n, v in zip(names, vals)]
    )


def q_winsorize(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "value")
    out = winsorize(ev, "value", WINSOR_P, out_col="winsorized_value")
    return out.select("event_id", "value", F.round("winsorized_value", 6).alias("winsorized_value"))


def q_percentile_by_group(spark, sf):
    ev = read_table(spark, sf, "events")
    out = percentile_cont_by(ev, ["event_type"], "value", WINSOR_P, out_col="p99")
    return out.select("event_type", F.round("p99", 6).alias("p99"))


def q_winsorize_by_group(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "event_type", "value")
    out = winsorize(ev, "value", WINSOR_P, out_col="winsorized_value", by=["event_type"])
    return out.select("event_id", "event_type", "value", F.round("winsorized_value", 6).alias("winsorized_value"))


# ── decoding and staging on the respondent frame ────────────────────────────
def q_decode_label(spark, sf):
    raw = raw_frame(spark, sf)
    return raw.select(
        "respondent_id",
        D.decode("bmi5cat", D.BMI_CATEGORY).alias("bmi_category"),
        D.decode("paindx3", D.PHYSICAL_ACTIVITY).alias("physical_activity_index"),
        D.decode("ageg5yr", D.AGE_GROUP).alias("age_group"),
        D.decode("race1", D.RACE_ETHNICITY).alias("race_ethnicity"),
        D.decode("racegr3", D.RACE_ETHNICITY_COLLAPSED).alias("race_ethnicity_collapsed"),
        D.decode("educa", D.EDUCATION).alias("education_level"),
        D.decode("income3", D.INCOME).alias("income_group"),
        D.decode("urbstat", D.URBAN_RURAL).alias("urban_rural"),
    )


def q_decode_default(spark, sf):
    raw = raw_frame(spark, sf)
    return raw.select(
        "respondent_id",
        "diabete4",
        D.decode("diabete4", D.DIABETES_STATUS, D.UNKNOWN).alias("diabetes_status"),
        D.decode("sexvar", D.SEX, D.UNKNOWN).alias("sex"),
    )


def q_decode_boolean(spark, sf):
    raw = raw_frame(spark, sf)
    return raw.select(
        "respondent_id",
        D.decode_bool("prediab2").alias("has_prediabetes"),
        D.decode_bool("insulin1").alias("takes_insulin"),
        D.decode_bool("cvdcrhd4").alias("has_coronary_heart_disease"),
        D.decode_bool("exerany2").alias("any_exercise_past_30d"),
    )


def q_decode_reversed(spark, sf):
    raw = raw_frame(spark, sf)
    return raw.select("respondent_id", "rfhype6", D.decode_bool("rfhype6", reversed_polarity=True).alias("has_hypertension"))


def q_sentinel_scale_round(spark, sf):
    raw = raw_frame(spark, sf)
    return raw.select("respondent_id", "bmi5", D.sentinel_scaled("bmi5").alias("bmi_calc"))


def q_lookup_join(spark, sf):
    # Row-level output: no global sort (that would range-shuffle the whole
    # table); NULLS LAST ordering is applied where the reference sorts, on
    # the small mart outputs.
    return staged(spark, sf).select("respondent_id", "state_fips", "state_abbr", "state_name")


def q_stg_frame(spark, sf):
    return staged(spark, sf)


def q_dim_demographics(spark, sf):
    return M.dim_demographics(staged(spark, sf))


def q_flags_3vl(spark, sf):
    return M.diabetes_flags(staged(spark, sf))


def q_category_cascade(spark, sf):
    return M.with_diabetes_flags(staged(spark, sf)).select(
        "respondent_id", "diabetes_status", "has_prediabetes", "takes_insulin", "diabetes_category"
    )


def q_risk_score(spark, sf):
    return M.metabolic_risk(staged(spark, sf))


def q_risk_score_joined(spark, sf):
    return M.metabolic_risk_joined(staged(spark, sf))


def q_normalized_weights(spark, sf):
    return survey_weights(staged(spark, sf))


def q_fct_prevalence(spark, sf):
    return M.prevalence(enriched(spark, sf))


def q_small_cell_suppression(spark, sf):
    return M.prevalence(enriched(spark, sf), strata=M.STATE_YEAR, min_cell=M.MIN_CELL)


def q_fct_risk_factors(spark, sf):
    return M.risk_factors(enriched(spark, sf))


def q_fct_risk_factors_joined(spark, sf):
    return M.risk_factors_joined(staged(spark, sf))


def q_landing_manifest(spark, sf):
    """Manifest of the table files themselves (size, SHA-256), rows-only."""
    return landing.manifest(spark, sf, glob="*.parquet", min_bytes=1)


def q_fct_state_year(spark, sf):
    return M.state_year_estimates(enriched(spark, sf))


TREND_STRATA = [*M.STATE_YEAR, "race_ethnicity"]


def q_trend_by_group(spark, sf):
    prev = M.prevalence(enriched(spark, sf), strata=TREND_STRATA, min_cell=TREND_MIN_CELL, sort=False)
    return M.trend_by_group(prev)


def q_ratio_of_sums(spark, sf):
    prev = M.prevalence(enriched(spark, sf), strata=M.STATE_YEAR, min_cell=M.MIN_CELL, sort=False)
    return M.national_prevalence(prev)


def q_national_prevalence_pct(spark, sf):
    prev = M.prevalence(enriched(spark, sf), strata=M.STATE_YEAR, min_cell=M.MIN_CELL, sort=False)
    return M.national_prevalence_pct(prev)


def q_assert_prevalence_reasonable(spark, sf):
    prev = M.prevalence(enriched(spark, sf), strata=M.STATE_YEAR, min_cell=M.MIN_CELL, sort=False)
    return M.prevalence_outside(prev, *PREVALENCE_RANGE)


def q_assert_weights_sum(spark, sf):
    return M.weights_outside(staged(spark, sf), *WEIGHT_POPULATION_RANGE)


def q_assert_prevalence_narrow(spark, sf):
    """A range that some years meet and some miss."""
    prev = M.prevalence(enriched(spark, sf), strata=M.STATE_YEAR, min_cell=M.MIN_CELL, sort=False)
    return M.prevalence_outside(prev, *NARROW_RANGE)


def q_extreme_weights(spark, sf):
    return survey_weights(staged(spark, sf), extreme_factor=EXTREME_FACTOR)


def q_fct_prevalence_small_cells(spark, sf):
    """The full strata with a limit that part of the cells reach."""
    return M.prevalence(enriched(spark, sf), min_cell=5)


def q_text_sha256(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha256"))


def _null_groups(spark, sf):
    grp = F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("grp")
    return read_table(spark, sf, "events").select("event_id", "value", grp)


def q_percentile_null_group(spark, sf):
    out = percentile_cont_by(_null_groups(spark, sf), ["grp"], "value", WINSOR_P, out_col="p99")
    return out.select("grp", F.round("p99", 6).alias("p99"))


def q_winsorize_null_group(spark, sf):
    out = winsorize(_null_groups(spark, sf), "value", WINSOR_P, out_col="winsorized_value", by=["grp"])
    return out.select("event_id", "grp", F.round("winsorized_value", 6).alias("winsorized_value"))


def _best_toxic(spark, sf):
    """One row a language and source; those without a toxic document have NULL."""
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "source")
    labels = read_table(spark, sf, "labels").select(F.col("doc_id").alias("labelled"), "toxic")
    best = F.max(F.when(F.col("toxic") == 1, F.col("labelled"))).alias("best")
    return docs.join(labels, F.col("doc_id") == F.col("labelled"), "left").groupBy("lang", "source").agg(best)


def q_order_nulls_last(spark, sf):
    order = [F.col("best").asc_nulls_last(), F.col("lang"), F.col("source")]
    return dense_row_id(_best_toxic(spark, sf), order, "place").withColumn("place", F.col("place").cast("bigint"))


def q_order_mixed(spark, sf):
    order = [F.col("lang").asc_nulls_last(), F.col("best").desc_nulls_last(), F.col("source")]
    return dense_row_id(_best_toxic(spark, sf), order, "place").withColumn("place", F.col("place").cast("bigint"))


def q_check_requested_years(spark, sf):
    """A requested year without rows, and a year whose file lacked a column."""
    years = [(y,) for y in (*S.DEFAULT_YEARS, ABSENT_YEAR)]
    return run_expectations(raw_frame(spark, sf), S.raw_expectations(), by=[YEAR], groups=years, absent=[(DROPPED_YEAR, DROPPED_COLUMN)])


def q_rows_by_year(spark, sf):
    return M.rows_by_year(raw_frame(spark, sf))


def q_weight_millions(spark, sf):
    return M.weight_millions(staged(spark, sf))


def q_union_years(spark, sf):
    raw = raw_frame(spark, sf)
    kept = raw.where(F.col(YEAR) != DROPPED_YEAR)
    drifted = raw.where(F.col(YEAR) == DROPPED_YEAR).drop("prediab2")
    parts = [project_allowlist(part, fill_missing=False)[0] for part in (kept, drifted)]
    unified = unify_years(parts)
    return unified.select("respondent_id", YEAR, "diabete4", "prediab2", WEIGHT)


def q_check_raw_expectations(spark, sf):
    return run_expectations(raw_frame(spark, sf), S.raw_expectations(), by=[YEAR])


def q_check_model_tests(spark, sf):
    """All 21 model tests in three passes: staging, flags and risk are row-local
    projections of the enriched frame, so their tests share one aggregate and
    one uniqueness count; the prevalence mart is its own aggregate."""
    rich = enriched(spark, sf)
    per_row = run_data_tests(
        rich,
        {
            "stg_respondents": S.staging_tests(),
            "int_diabetes_flags": S.flags_tests(),
            "int_metabolic_risk": S.risk_tests(),
        },
    )
    mart = run_data_tests(M.prevalence(rich, sort=False), S.prevalence_tests(), "fct_diabetes_prevalence")
    return per_row.unionByName(mart)


def q_check_events_expectations(spark, sf):
    return run_expectations(read_table(spark, sf, "events"), S.events_expectations(), by=["event_type"])


def q_check_events_tests(spark, sf):
    return run_data_tests(read_table(spark, sf, "events"), S.events_tests(), "events")


QUERIES: dict[str, Query] = {
    "weighted_proportion": q_weighted_proportion,
    "weighted_count": q_weighted_count,
    "weighted_proportion_null_outcome": q_weighted_proportion_null_outcome,
    "weighted_mean_null_aware": q_weighted_mean_null_aware,
    "unweighted_proportion": q_unweighted_proportion,
    "conditional_count": q_conditional_count,
    "having_weight_range": q_having_weight_range,
    "positive_weight_filter": q_positive_weight_filter,
    "dense_row_id": q_dense_row_id,
    "percentile": q_percentile,
    "winsorize": q_winsorize,
    "percentile_by_group": q_percentile_by_group,
    "winsorize_by_group": q_winsorize_by_group,
    "decode_label": q_decode_label,
    "decode_default": q_decode_default,
    "decode_boolean": q_decode_boolean,
    "decode_reversed": q_decode_reversed,
    "sentinel_scale_round": q_sentinel_scale_round,
    "lookup_join": q_lookup_join,
    "stg_frame": q_stg_frame,
    "dim_demographics": q_dim_demographics,
    "flags_3vl": q_flags_3vl,
    "category_cascade": q_category_cascade,
    "risk_score": q_risk_score,
    "risk_score_joined": q_risk_score_joined,
    "normalized_weights": q_normalized_weights,
    "fct_prevalence": q_fct_prevalence,
    "small_cell_suppression": q_small_cell_suppression,
    "fct_risk_factors": q_fct_risk_factors,
    "fct_risk_factors_joined": q_fct_risk_factors_joined,
    "fct_state_year": q_fct_state_year,
    "trend_by_group": q_trend_by_group,
    "ratio_of_sums": q_ratio_of_sums,
    "national_prevalence_pct": q_national_prevalence_pct,
    "assert_prevalence_reasonable": q_assert_prevalence_reasonable,
    "assert_weights_sum": q_assert_weights_sum,
    "rows_by_year": q_rows_by_year,
    "weight_millions": q_weight_millions,
    "union_years": q_union_years,
    "check_raw_expectations": q_check_raw_expectations,
    "check_requested_years": q_check_requested_years,
    "assert_prevalence_narrow": q_assert_prevalence_narrow,
    "extreme_weights": q_extreme_weights,
    "fct_prevalence_small_cells": q_fct_prevalence_small_cells,
    "text_sha256": q_text_sha256,
    "percentile_null_group": q_percentile_null_group,
    "winsorize_null_group": q_winsorize_null_group,
    "order_nulls_last": q_order_nulls_last,
    "order_mixed": q_order_mixed,
    "check_model_tests": q_check_model_tests,
    "landing_manifest": q_landing_manifest,
    "check_events_expectations": q_check_events_expectations,
    "check_events_tests": q_check_events_tests,
}


# ── oracle SQL ──────────────────────────────────────────────────────────────
def _state_year_prev(min_cell: int = M.MIN_CELL) -> str:
    return prevalence_sql(M.STATE_YEAR, min_cell)


def _sql() -> dict[str, str]:
    d, h = DISCOUNT_CUT, HIGH_VALUE_CUT
    lo, hi = LINEITEM_YEAR_RANGE
    plo, phi = PREVALENCE_RANGE
    wlo, whi = WEIGHT_POPULATION_RANGE
    doc_labels = (
        "(SELECT d.doc_id, d.lang, CAST(d.n_chars AS DOUBLE) AS w, l.quality, l.toxic "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) dl"
    )
    pct_names = ", ".join(
        f"round(quantile_cont(value, {p}), 6) AS p{int(round(p * 100))}" for p in PERCENTILES
    )
    shown = "FILTER (WHERE weighted_diabetes_prevalence IS NOT NULL)"
    national = f"""
  SELECT survey_year, coalesce(sum(weighted_n_diabetic) {shown}, 0) / nullif(sum(weighted_n_total) {shown}, 0)
    AS national_weighted_prevalence
  FROM prev GROUP BY survey_year"""

    def outside(low: float, high: float) -> str:
        return f""", prev AS ({_state_year_prev()}), nat AS ({national})
SELECT survey_year, round(100 * national_weighted_prevalence, 2) AS prevalence_pct
FROM nat WHERE national_weighted_prevalence < {low} OR national_weighted_prevalence > {high}"""

    risk_shares = shares({
        "pct_obese": "obese_flag = 1", "pct_hypertensive": "hypertension_flag = 1", "pct_inactive": "inactive_flag = 1",
        "pct_no_exercise": "no_exercise_flag = 1", "pct_poor_diet": "poor_diet_flag = 1",
        "pct_high_metabolic_risk": "high_metabolic_risk",
    })
    state_shares = shares({
        "pct_diagnosed_diabetic": "is_diagnosed_diabetic", "pct_prediabetic": "is_prediabetic",
        "pct_insulin_dependent": "is_insulin_dependent", "pct_obese": "bmi_category = 'Obese'",
        "pct_overweight_or_obese": "bmi_category IN ('Obese', 'Overweight')", "pct_hypertensive": "has_hypertension",
        "pct_coronary_heart_disease": "has_coronary_heart_disease", "pct_any_exercise": "any_exercise_past_30d",
        "pct_inactive": "physical_activity_index = 'Inactive'", "pct_high_metabolic_risk": "high_metabolic_risk",
    })

    def weights(factor: float) -> str:
        return f"""
SELECT respondent_id, survey_year, state_fips, state_abbr, llcpwt, ststr, psu,
       llcpwt / sum(llcpwt) OVER y * count(*) OVER y AS normalized_weight,
       count(*) OVER y AS year_n_respondents, sum(llcpwt) OVER y AS year_total_weight,
       llcpwt > sum(llcpwt) OVER y / count(*) OVER y * {factor} AS is_extreme_weight
FROM stg WINDOW y AS (PARTITION BY survey_year)"""

    return {
        "weighted_proportion": f"""
SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS ship_year,
       count(*) AS n_rows, sum(l_quantity) AS weighted_n,
       sum(CASE WHEN l_discount > {d} THEN l_quantity ELSE 0 END) / nullif(sum(l_quantity), 0) AS prop_discounted
FROM lineitem GROUP BY 1, 2, 3""",
        "weighted_count": f"""
SELECT l_returnflag, l_linestatus, count(*) AS n_rows,
       count(CASE WHEN l_discount > {d} THEN 1 END) AS n_discounted,
       sum(CASE WHEN l_discount > {d} THEN l_quantity ELSE 0 END) AS weighted_n_discounted,
       sum(l_quantity) AS weighted_n
FROM lineitem GROUP BY 1, 2""",
        "weighted_proportion_null_outcome": f"""
SELECT lang, count(*) AS n_docs, sum(w) AS weighted_n,
       sum(CASE WHEN quality = 1 THEN w ELSE 0 END) / nullif(sum(w), 0) AS prop_quality,
       sum(CASE WHEN toxic = 1 THEN w ELSE 0 END) / nullif(sum(w), 0) AS prop_toxic
FROM {doc_labels} GROUP BY lang""",
        "weighted_mean_null_aware": f"""
SELECT lang,
       sum(quality * w) / nullif(sum(CASE WHEN quality IS NOT NULL THEN w END), 0) AS mean_quality,
       sum(quality * w) / nullif(sum(w), 0) AS mean_quality_all_weights,
       sum(toxic * w) / nullif(sum(CASE WHEN toxic IS NOT NULL THEN w END), 0) AS mean_toxic
FROM {doc_labels} GROUP BY lang""",
        "unweighted_proportion": f"""
SELECT event_type, count(*) AS n_events,
       avg(CASE WHEN value > {h} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS share_high_value
FROM events GROUP BY event_type""",
        "conditional_count": f"""
SELECT event_type, count(*) AS n_events, count(CASE WHEN value > {h} THEN 1 END) AS n_high_value
FROM events GROUP BY event_type""",
        "having_weight_range": f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, round(sum(l_quantity) / 1e6, 1) AS total_weight_millions,
       count(*) AS n_rows
FROM lineitem GROUP BY 1 HAVING sum(l_quantity) NOT BETWEEN {lo} AND {hi}""",
        "positive_weight_filter": "SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_acctbal > 0",
        "dense_row_id": """
SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS row_id FROM orders""",
        "percentile": f"SELECT {pct_names} FROM events",
        "winsorize": f"""
WITH q AS (SELECT quantile_cont(value, {WINSOR_P}) AS cap FROM events)
SELECT event_id, value, round(least(value, cap), 6) AS winsorized_value FROM events, q""",
        "percentile_by_group": f"""
SELECT event_type, round(quantile_cont(value, {WINSOR_P}), 6) AS p99 FROM events GROUP BY event_type""",
        "winsorize_by_group": f"""
WITH q AS (SELECT event_type, quantile_cont(value, {WINSOR_P}) AS cap FROM events GROUP BY event_type)
SELECT e.event_id, e.event_type, e.value, round(least(e.value, q.cap), 6) AS winsorized_value
FROM events e LEFT JOIN q ON e.event_type = q.event_type""",
        "decode_label": with_survey("""
SELECT respondent_id, bmi_category, physical_activity_index, age_group, race_ethnicity,
       race_ethnicity_collapsed, education_level, income_group, urban_rural
FROM (SELECT """ + DECODED_SELECT + " FROM raw) x"),
        "decode_default": with_survey("""
SELECT respondent_id, diabete4, diabetes_status, sex FROM (SELECT diabete4, """ + DECODED_SELECT + " FROM raw) x"),
        "decode_boolean": with_survey("""
SELECT respondent_id, has_prediabetes, takes_insulin, has_coronary_heart_disease, any_exercise_past_30d
FROM (SELECT """ + DECODED_SELECT + " FROM raw) x"),
        "decode_reversed": with_survey("""
SELECT respondent_id, rfhype6, has_hypertension FROM (SELECT rfhype6, """ + DECODED_SELECT + " FROM raw) x"),
        "sentinel_scale_round": with_survey("""
SELECT respondent_id, bmi5, bmi_calc FROM (SELECT bmi5, """ + DECODED_SELECT + " FROM raw) x"),
        "lookup_join": with_survey("SELECT respondent_id, state_fips, state_abbr, state_name FROM stg"),
        "stg_frame": with_survey("SELECT * FROM stg"),
        "dim_demographics": with_survey("""
SELECT respondent_id, survey_year, state_fips, state_abbr, state_name, interview_month, interview_year, sex,
       age_group, race_ethnicity, race_ethnicity_collapsed, education_level, income_group, urban_rural
FROM stg"""),
        "flags_3vl": with_survey("""
SELECT s.respondent_id, s.survey_year, s.llcpwt, f.is_diagnosed_diabetic, f.is_prediabetic,
       f.is_insulin_dependent, f.diabetes_category
FROM stg s JOIN flags f USING (respondent_id)"""),
        "category_cascade": with_survey("""
SELECT s.respondent_id, s.diabetes_status, s.has_prediabetes, s.takes_insulin, f.diabetes_category
FROM stg s JOIN flags f USING (respondent_id)"""),
        "risk_score": with_survey("SELECT * FROM risk"),
        "risk_score_joined": with_survey("SELECT * FROM risk"),
        "normalized_weights": with_survey(weights(20)),
        "extreme_weights": with_survey(weights(EXTREME_FACTOR)),
        "fct_prevalence_small_cells": with_survey(prevalence_sql(M.PREVALENCE_STRATA, 5)),
        "fct_prevalence": with_survey(prevalence_sql(M.PREVALENCE_STRATA, M.MIN_CELL)),
        "small_cell_suppression": with_survey(_state_year_prev()),
        "fct_risk_factors": with_survey(f"""
SELECT survey_year, diabetes_category, count(*) AS unweighted_n, sum(llcpwt) AS weighted_n, {risk_shares},
  sum(llcpwt * metabolic_risk_score) / nullif(sum(llcpwt) FILTER (WHERE metabolic_risk_score IS NOT NULL), 0)
    AS mean_metabolic_risk_score
FROM enriched WHERE diabetes_category <> 'Unknown' GROUP BY ALL"""),
        "fct_state_year": with_survey(f"""
SELECT survey_year, state_fips, state_abbr, state_name, count(*) AS unweighted_n,
  sum(llcpwt) AS estimated_adult_population, {state_shares}
FROM enriched GROUP BY ALL"""),
        "trend_by_group": with_survey(f""", prev AS ({prevalence_sql(TREND_STRATA, TREND_MIN_CELL)})
SELECT survey_year, race_ethnicity, round(100 * sum(weighted_n_diabetic) / nullif(sum(weighted_n_total), 0), 1)
         AS diabetes_pct, CAST(sum(unweighted_n) AS BIGINT) AS n_respondents
FROM prev WHERE weighted_diabetes_prevalence IS NOT NULL GROUP BY ALL"""),
        "ratio_of_sums": with_survey(f", prev AS ({_state_year_prev()})\n{national}"),
        "national_prevalence_pct": with_survey(f""", prev AS ({_state_year_prev()})
SELECT survey_year, round(100 * sum(weighted_n_diabetic) {shown} / nullif(sum(weighted_n_total) {shown}, 0), 2)
         AS national_prevalence_pct, CAST(sum(unweighted_n) {shown} AS BIGINT) AS n_respondents
FROM prev GROUP BY survey_year HAVING count(weighted_diabetes_prevalence) > 0"""),
        "assert_prevalence_reasonable": with_survey(outside(plo, phi)),
        "assert_prevalence_narrow": with_survey(outside(*NARROW_RANGE)),
        "assert_weights_sum": with_survey(f"""
SELECT * FROM (SELECT survey_year, round(sum(llcpwt) / 1e6, 1) AS total_weight_millions, count(*) AS n_respondents,
                      sum(llcpwt) < {wlo} OR sum(llcpwt) > {whi} AS off FROM stg GROUP BY survey_year) t WHERE off"""
                                          .replace("SELECT * FROM", "SELECT * EXCLUDE (off) FROM", 1)),
        "text_sha256": "SELECT doc_id, sha256(text) AS text_sha256 FROM documents",
        "percentile_null_group": f"""
SELECT grp, round(quantile_cont(value, {WINSOR_P}), 6) AS p99 FROM ({NULL_GROUPS_SQL}) e GROUP BY grp""",
        "winsorize_null_group": f"""
WITH e AS ({NULL_GROUPS_SQL}), q AS (SELECT grp, quantile_cont(value, {WINSOR_P}) AS cap FROM e GROUP BY grp)
SELECT e.event_id, e.grp, round(least(e.value, q.cap), 6) AS winsorized_value
FROM e LEFT JOIN q ON e.grp IS NOT DISTINCT FROM q.grp""",
        "order_nulls_last": """
SELECT lang, source, best, row_number() OVER (ORDER BY best ASC NULLS LAST, lang, source) AS place FROM (
  SELECT d.lang, d.source, max(CASE WHEN l.toxic = 1 THEN l.doc_id END) AS best
  FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY ALL) t""",
        "order_mixed": """
SELECT lang, source, best, row_number() OVER (ORDER BY lang ASC NULLS LAST, best DESC NULLS LAST, source) AS place FROM (
  SELECT d.lang, d.source, max(CASE WHEN l.toxic = 1 THEN l.doc_id END) AS best
  FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY ALL) t""",
        "check_requested_years": _requested_years_sql(),
        "rows_by_year": with_survey("SELECT survey_year, count(*) AS n_rows FROM raw GROUP BY survey_year"),
        "weight_millions": with_survey("""
SELECT survey_year, round(sum(llcpwt) / 1e6, 1) AS total_weight_millions, count(*) AS n_respondents
FROM stg GROUP BY survey_year"""),
        "union_years": with_survey(f"""
SELECT respondent_id, survey_year, diabete4, prediab2, llcpwt FROM (
  SELECT * FROM raw WHERE survey_year <> {DROPPED_YEAR}
  UNION ALL BY NAME
  SELECT * EXCLUDE (prediab2) FROM raw WHERE survey_year = {DROPPED_YEAR}) u"""),
        "check_raw_expectations": _raw_expectations_sql(),
        "check_model_tests": _model_tests_sql(),
        "check_events_expectations": "WITH " + _expectations_body(
            "events", "event_type", S.events_expectations(), set(EVENTS_COLUMNS), lead=""),
        "check_events_tests": "\nUNION ALL\n".join(_data_tests_selects([("events", "events", S.events_tests())])),
    }


def _requested_years_sql() -> str:
    """The suite with a year that is not there and a year without a column."""
    gone = f"survey_year = {DROPPED_YEAR} AND column_name = '{DROPPED_COLUMN}'"
    body = _expectations_body("raw", "survey_year", S.raw_expectations(), set(RAW_FRAME_COLUMNS))
    return f"""SELECT survey_year, check_name, kind, column_name,
  CASE WHEN {gone} THEN if(kind = 'column_exists', 0.0, NULL) ELSE observed END AS observed,
  threshold, passed AND NOT coalesce({gone}, FALSE) AS passed, severity FROM ({with_survey(body)}) b
UNION ALL SELECT {ABSENT_YEAR}, check_name, kind, column_name,
  CASE kind WHEN 'row_count_between' THEN 0.0 WHEN 'column_exists' THEN 1.0 END, threshold,
  kind <> 'row_count_between', severity FROM ({with_survey(body)}) c WHERE survey_year = {DROPPED_YEAR}"""


def _sql_str(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _raw_expectations_sql() -> str:
    """Independent SQL of the raw suite: one metrics row per year, then one
    SELECT per check."""
    return with_survey(_expectations_body("raw", "survey_year", S.raw_expectations(), set(RAW_FRAME_COLUMNS)))


RAW_FRAME_COLUMNS = ["respondent_id", "diabete4", "prediab2", "insulin1", "bmi5", "bmi5cat", "rfhype6", "cvdcrhd4",
                     "exerany2", "paindx3", "fruit2", "fruitju2", "vegetab2", "state", "imonth", "iyear", "sexvar",
                     "ageg5yr", "race1", "racegr3", "educa", "income3", "urbstat", "llcpwt", "ststr", "psu",
                     "survey_year", "loaded_at"]
EVENTS_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _expectations_body(table: str, by: str, checks, present: set[str], lead: str = ", ") -> str:
    """SQL: metrics CTE ``m`` per ``by`` group, then one SELECT per check."""
    metrics, selects = ["count(*) AS n"], []
    for i, c in enumerate(checks):
        col = c.column
        head = f"{by}, {_sql_str(c.name)} AS check_name, {_sql_str(c.kind)} AS kind, " \
               f"CAST({_sql_str(col)} AS VARCHAR) AS column_name"
        sev = f"{_sql_str(c.severity)} AS severity"
        if c.kind == "row_count_between":
            thr = f"[{c.min_value:g}, {c.max_value:g}]"
            selects.append(f"SELECT {head}, CAST(n AS DOUBLE) AS observed, {_sql_str(thr)} AS threshold, "
                           f"n BETWEEN {c.min_value} AND {c.max_value} AS passed, {sev} FROM m")
            continue
        if c.kind == "column_exists":
            ok = col in present
            selects.append(f"SELECT {head}, CAST({1.0 if ok else 0.0} AS DOUBLE) AS observed, 'present' AS threshold, "
                           f"{'TRUE' if ok else 'FALSE'} AS passed, {sev} FROM m")
            continue
        if c.kind == "not_null":
            metrics += [f"count(*) AS d{i}", f"count({col}) AS k{i}"]
        elif c.kind == "between":
            metrics += [f"count({col}) AS d{i}", f"count_if({col} BETWEEN {c.min_value} AND {c.max_value}) AS k{i}"]
        else:
            vals = ", ".join(str(v) for v in c.values)
            metrics += [f"count({col}) AS d{i}", f"count_if({col} IN ({vals})) AS k{i}"]
        obs = f"CASE WHEN d{i} > 0 THEN CAST(k{i} AS DOUBLE) / CAST(d{i} AS DOUBLE) END"
        selects.append(f"SELECT {head}, {obs} AS observed, {_sql_str(f'>= {c.mostly:g}')} AS threshold, "
                       f"coalesce({obs} >= {c.mostly}, TRUE) AS passed, {sev} FROM m")
    m = f"{lead}m AS (SELECT {by}, {', '.join(metrics)} FROM {table} GROUP BY {by})\n"
    return m + "\nUNION ALL\n".join(selects)


def _data_tests_selects(tables) -> list[str]:
    selects = []
    for model, table, checks in tables:
        for c in checks:
            head = f"{_sql_str(model)} AS model, {_sql_str(c.name)} AS test_name, {_sql_str(c.kind)} AS kind, " \
                   f"CAST({_sql_str(c.column)} AS VARCHAR) AS column_name"
            if c.kind == "unique":
                fails = (f"(SELECT count(*) FROM (SELECT {c.column} FROM {table} WHERE {c.column} IS NOT NULL "
                         f"GROUP BY {c.column} HAVING count(*) > 1) d)")
                selects.append(f"SELECT {head}, CAST({fails} AS BIGINT) AS n_failures, {fails} = 0 AS passed, "
                               f"{_sql_str(c.severity)} AS severity")
                continue
            if c.kind == "not_null":
                cond = f"{c.column} IS NULL"
            elif c.kind == "accepted_values":
                vals = ", ".join(_sql_str(v) if isinstance(v, str) else str(v) for v in c.values)
                cond = f"{c.column} IS NOT NULL AND {c.column} NOT IN ({vals})"
            else:
                cond = f"coalesce(NOT ({c.expression}), FALSE)"
            selects.append(f"SELECT {head}, CAST(count_if({cond}) AS BIGINT) AS n_failures, "
                           f"count_if({cond}) = 0 AS passed, {_sql_str(c.severity)} AS severity FROM {table}")
    return selects


def _model_tests_sql() -> str:
    tables = [
        ("stg_respondents", "stg", S.staging_tests()),
        ("int_diabetes_flags", "flags", S.flags_tests()),
        ("int_metabolic_risk", "risk", S.risk_tests()),
        ("fct_diabetes_prevalence", "prev", S.prevalence_tests()),
    ]
    selects = _data_tests_selects(tables)
    flags_full = """, flags_model AS (SELECT s.respondent_id, s.survey_year, s.llcpwt, f.is_diagnosed_diabetic,
       f.is_prediabetic, f.is_insulin_dependent, f.diabetes_category FROM stg s JOIN flags f USING (respondent_id))"""
    body = (f", prev AS ({prevalence_sql(M.PREVALENCE_STRATA, M.MIN_CELL)})\n{flags_full}\n"
            + "\nUNION ALL\n".join(selects).replace(" FROM flags", " FROM flags_model"))
    return with_survey(body)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    sqls = _sql()
    # the joined plan of the same mart has the same oracle by definition
    sqls["fct_risk_factors_joined"] = sqls["fct_risk_factors"]
    return sqls
