"""Invariants of the marts on the sf0.01 respondent frame."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stratiform.operators.weights import survey_weights
from stratiform.plans import models as M
from stratiform.plans import registry as R

from conftest import SF_ORACLE


@pytest.fixture(scope="module")
def rich(spark):
    return M.enrich(R.staged(spark, SF_ORACLE)).cache()


def test_prevalence_invariants(rich):
    prev = M.prevalence(rich, strata=M.STATE_YEAR, min_cell=M.MIN_CELL, sort=False).collect()
    assert prev
    for r in prev:
        masked = r.weighted_diabetes_prevalence is None
        assert masked == (r.unweighted_n < M.MIN_CELL)          # suppressed <=> n < min_cell
        if not masked:
            assert 0.0 <= r.weighted_diabetes_prevalence <= 1.0
            assert r.weighted_n_diabetic == pytest.approx(r.weighted_diabetes_prevalence * r.weighted_n_total)
        assert 0 <= r.unweighted_n_diabetic <= r.unweighted_n


def test_state_year_proportions_in_unit_interval(rich):
    for r in M.state_year_estimates(rich, sort=False).collect():
        for k, v in r.asDict().items():
            if k.startswith("pct_") and v is not None:
                assert 0.0 <= v <= 1.0


def test_normalised_weights_sum_to_n_per_year(rich):
    w = survey_weights(rich)
    per_year = w.groupBy("survey_year").agg(F.sum("normalized_weight").alias("s"), F.count(F.lit(1)).alias("n"))
    for r in per_year.collect():
        assert r.s == pytest.approx(r.n, rel=1e-9)


def test_key_unique_and_risk_score_range(rich):
    assert rich.groupBy("respondent_id").count().where("count > 1").count() == 0
    bad = rich.where("metabolic_risk_score IS NOT NULL AND NOT metabolic_risk_score BETWEEN 0 AND 5").count()
    assert bad == 0 and rich.where("metabolic_risk_score IS NULL").count() == 0
