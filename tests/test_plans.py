"""Plan-shape checks: pushdown, pruning, broadcast only of bounded sides,
no single-partition exchange in the models, no Python on the hot path."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from stratiform.plans import models as M
from stratiform.plans import registry as R
from stratiform.sources import ingest
from stratiform.sources.seeds import state_codes

from conftest import SF_SMOKE


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["stg_frame", "fct_prevalence", "fct_risk_factors", "fct_state_year", "normalized_weights",
     "weighted_proportion", "check_raw_expectations"],
)
def test_no_single_partition_and_no_python(spark, name):
    plan = physical(R.queries()[name](spark, SF_SMOKE))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_staging_broadcasts_only_the_state_list(spark):
    plan = physical(R.staged(spark, SF_SMOKE))
    assert plan.count("BroadcastExchange") == 1 and "SortMergeJoin" not in plan


def test_marts_single_shuffle_for_aggregation(spark):
    plan = physical(M.risk_factors(R.enriched(spark, SF_SMOKE), sort=False))
    assert plan.count("Exchange hashpartitioning") == 1


def test_weight_filter_and_pruning_reach_parquet(spark, scratch_dir):
    path = os.path.join(scratch_dir, "raw")
    ingest.write_raw(R.raw_frame(spark, SF_SMOKE), path)
    raw = ingest.read_raw(spark, path, [2022])
    staged = M.staging(raw, state_codes(spark))
    prev = M.prevalence(M.enrich(staged), sort=False)
    plan = physical(prev)
    pushed = plan[plan.index("PushedFilters: ["):].split("]")[0]
    assert "GreaterThan(llcpwt,0.0)" in pushed and "IsNotNull(llcpwt)" in pushed
    # the domain filters on derived labels reach the scan as IS NOT NULL on the codes
    assert "IsNotNull(ageg5yr)" in pushed and "IsNotNull(racegr3)" in pushed
    assert "PartitionFilters: [isnotnull(survey_year" in plan
    scan = [ln for ln in plan.splitlines() if "ReadSchema" in ln][0]
    assert "loaded_at" not in scan and "fruit2" not in scan and "educa" not in scan
    assert F is not None


def test_left_joins_filtered_on_right_side_become_inner(spark):
    plan = physical(M.risk_factors_joined(R.staged(spark, SF_SMOKE), sort=False))
    key_joins = [ln for ln in plan.splitlines() if "Join [respondent_id" in ln]
    assert len(key_joins) == 2
    # the join whose right side is filtered (diabetes_category IN ...) is inner
    assert sum("Inner" in ln for ln in key_joins) == 1
