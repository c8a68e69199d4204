"""Hand-computed estimator cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stratiform.functions import estimators as E


def test_null_outcome_counts_as_no(spark):
    df = spark.createDataFrame([(True, 2.0), (None, 3.0), (False, 5.0)], "y boolean, w double")
    r = df.agg(E.weighted_proportion(F.col("y"), "w").alias("p")).collect()[0]
    assert r.p == pytest.approx(0.2)


def test_weighted_mean_null_aware(spark):
    df = spark.createDataFrame([(2, 1.0), (None, 9.0), (4, 1.0)], "x int, w double")
    r = df.agg(E.weighted_mean("x", "w").alias("m")).collect()[0]
    assert r.m == pytest.approx(3.0)


def test_zero_weights_give_null(spark):
    df = spark.createDataFrame([(True, 0.0), (False, 0.0)], "y boolean, w double")
    r = df.agg(E.weighted_proportion(F.col("y"), "w").alias("p"), E.weighted_mean(F.lit(1), "w").alias("m")).collect()[0]
    assert r.p is None and r.m is None


def test_weighted_count_equals_proportion_times_total(spark):
    df = spark.createDataFrame([(i % 3 == 0, float(i)) for i in range(1, 50)], "y boolean, w double")
    r = df.agg(
        E.weighted_count(F.col("y"), "w").alias("c"),
        E.weighted_proportion(F.col("y"), "w").alias("p"),
        E.weighted_total("w").alias("t"),
    ).collect()[0]
    assert r.c == pytest.approx(r.p * r.t)


def test_condition_as_sql_text(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0)], "k int, w double")
    r = df.agg(E.weighted_proportion("k = 2", "w").alias("p")).collect()[0]
    assert r.p == pytest.approx(0.75)


def test_unweighted_and_conditional_count(spark):
    df = spark.createDataFrame([(True,), (None,), (False,), (True,)], "y boolean")
    r = df.agg(E.unweighted_proportion(F.col("y")).alias("p"), E.conditional_count(F.col("y")).alias("n")).collect()[0]
    assert r.p == pytest.approx(0.5) and r.n == 2


def test_suppression_masks_but_keeps_rows(spark):
    df = spark.createDataFrame([("a", 49, 0.1), ("b", 50, 0.2)], "g string, n bigint, p double")
    out = {r.g: r.p for r in df.select("g", E.suppress("p", "n", 50).alias("p")).collect()}
    assert out == {"a": None, "b": 0.2}


def test_grouped_estimates_single_aggregate(spark):
    df = spark.createDataFrame([("a", True, 1.0)], "g string, y boolean, w double")
    q = df.groupBy("g").agg(
        E.weighted_proportion(F.col("y"), "w").alias("p1"),
        E.weighted_proportion(~F.col("y"), "w").alias("p2"),
    )
    plan = q._jdf.queryExecution().executedPlan().toString()
    # one partial + one final aggregate, one exchange, and sum(w) shared
    assert plan.count("Exchange hashpartitioning") <= 1
