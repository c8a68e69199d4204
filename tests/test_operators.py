"""Distributed operators: dense row id, exact percentile, winsorize, weights."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratiform.operators.keys import dense_row_id
from stratiform.operators.quantile import percentile_cont, percentiles_cont, winsorize
from stratiform.operators.weights import survey_weights
from stratiform.plans import models as M
from stratiform.plans.frame import raw_frame
from stratiform.sources.seeds import state_codes

from conftest import SF_SMOKE


def test_dense_row_id_matches_global_row_number(spark):
    orders = spark.read.parquet(f"{SF_SMOKE}/orders.parquet").select("o_orderkey")
    ours = dense_row_id(orders, ["o_orderkey"], num_partitions=5)
    ref = orders.withColumn("row_id", F.row_number().over(Window.orderBy("o_orderkey")))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, ref.collect()))


def test_dense_row_id_is_stable_across_actions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    ids = dense_row_id(df, ["k"], num_partitions=7)
    a = ids.orderBy("k").collect()
    b = ids.orderBy("k").collect()
    assert a == b and [r.row_id for r in a] == list(range(1, 5001))


def test_dense_row_id_plan_has_no_single_partition(spark):
    df = spark.range(0, 100).withColumn("k", F.col("id"))
    plan = dense_row_id(df, ["k"], num_partitions=4)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_percentile_small_case(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (1000.0,)], "w double")
    assert percentile_cont(df, "w", 0.99) == pytest.approx(980.04)


def test_percentile_matches_numpy_with_ties_and_nulls(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.integers(0, 50, 3000).astype(float), np.full(2000, 17.0)])
    rows = [(float(v),) for v in vals] + [(None,)] * 10
    df = spark.createDataFrame(rows, "v double")
    ps = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = percentiles_cont(df, "v", ps)
    want = np.quantile(vals, ps, method="linear")
    assert got == pytest.approx(list(want))


def test_percentile_empty(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert percentile_cont(df, "v", 0.5) is None


def test_winsorize_caps_and_null_becomes_cap(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (1000.0,), (None,)], "w double")
    out = sorted(r.c for r in winsorize(df, "w", 0.99, out_col="c").collect())
    assert out == pytest.approx([1.0, 2.0, 980.04, 980.04])


def test_normalized_weights_sum_to_n_and_extreme_flag(spark):
    rows = [(i, 2022, 1, "AL", 1.0, 1.0, 1.0) for i in range(100)] + [(100, 2022, 1, "AL", 30.0, 1.0, 1.0)]
    df = spark.createDataFrame(
        rows, "respondent_id bigint, survey_year int, state_fips int, state_abbr string, llcpwt double, "
        "ststr double, psu double"
    )
    out = survey_weights(df).collect()
    assert sum(r.normalized_weight for r in out) == pytest.approx(101, rel=1e-9)
    assert [r.respondent_id for r in out if r.is_extreme_weight] == [100]


def test_joined_and_row_local_risk_plans_agree(spark):
    staged = M.staging(raw_frame(spark, SF_SMOKE), state_codes(spark))
    a = M.metabolic_risk(staged)
    b = M.metabolic_risk_joined(staged)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_staging_without_key_uses_dense_row_id(spark):
    raw = raw_frame(spark, SF_SMOKE)
    keyed = raw.withColumn("record_no", F.col("respondent_id") - 1).drop("respondent_id")
    staged = M.staging(keyed, state_codes(spark), key_order=["record_no"])
    ids = [r.respondent_id for r in staged.select("respondent_id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_dense_row_id_with_offsets_table(spark, monkeypatch):
    import stratiform.operators.keys as K

    df = spark.range(0, 3000).select((F.col("id") * 7 % 3000).alias("k"))
    ids = dense_row_id(df, ["k"], num_partitions=9).orderBy("k").collect()
    assert [r.row_id for r in ids] == list(range(1, 3001))


def test_describe_attaches_comments(spark):
    from stratiform.sources.ingest import describe

    df = describe(spark.createDataFrame([(1.0, 2021)], "llcpwt double, survey_year int"))
    assert df.schema["llcpwt"].metadata["comment"] == "Final combined survey weight"


def test_dense_row_id_splits_a_hot_value(spark):
    # a third of the rows share one order value: they must not land in one partition
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    ids = dense_row_id(df, ["k"], num_partitions=6)
    sizes = ids.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) < 1000
    assert sorted(r.row_id for r in ids.collect()) == list(range(1, 3001))


def test_tune_session_keeps_user_settings(spark):
    from stratiform.session import tune_session

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32MB")
    try:
        tune_session(spark)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "32MB"
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        tune_session(spark)
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_lookup_join_and_null_safe_join(spark):
    from stratiform.operators.joins import lookup_join, null_safe

    big = spark.range(0, 50).withColumnRenamed("id", "k")
    small = spark.range(0, 5).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    assert lookup_join(big, small, "k").where(F.col("v").isNull()).count() == 45
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "g string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "g string, y int")
    got = sorted(map(tuple, null_safe(left, right, ["g"], "left").collect()), key=lambda r: r[1])
    assert got == [(None, 1, 10), ("a", 2, 20), ("b", 3, None)]


def test_operators_keep_nothing_cached(spark):
    from stratiform.operators.weights import attach_group_totals

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = spark.createDataFrame([("x", 1.0), (None, 2.0), (None, 4.0)], "g string, llcpwt double")
    assert attach_group_totals(df, ["g"]).where("g IS NULL").first()["total_weight"] == 6.0
    winsorize(df, "llcpwt", 0.99, out_col="c", by=["g"]).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_percentile_keeps_the_null_group_and_needs_no_sort_of_the_column(spark):
    from stratiform.operators.quantile import percentile_cont_by

    rng = np.random.default_rng(3)
    rows = [(None if i % 3 else "a", float(v)) for i, v in enumerate(rng.normal(size=4000))]
    df = spark.createDataFrame(rows, "g string, v double")
    for p in (0.0, 0.013, 0.5, 0.999, 1.0):
        got = {r.g: r.p for r in percentile_cont_by(df, ["g"], "v", p, out_col="p").collect()}
        want = {g: float(np.quantile([v for k, v in rows if k == g], p)) for g in (None, "a")}
        assert got == pytest.approx(want)
    assert "rangepartitioning" not in percentile_cont_by(df, ["g"], "v", 0.5)._jdf.queryExecution().toString()
    capped = winsorize(df, "v", 0.9, out_col="c", by=["g"])
    cap = float(np.quantile([v for k, v in rows if k is None], 0.9))
    assert capped.where("g IS NULL").agg(F.max("c")).first()[0] == pytest.approx(cap)


def test_grouped_percentile_matches_numpy_with_hot_group(spark):
    from stratiform.operators.quantile import percentile_cont_by

    rng = np.random.default_rng(11)
    rows = [("hot", float(v)) for v in rng.integers(0, 100, 3000)]        # a group with most rows
    rows += [("a", float(v)) for v in rng.integers(0, 10, 200)] + [("b", 5.0)] + [("a", None)] * 5
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.p for r in percentile_cont_by(df, ["g"], "v", 0.9, out_col="p").collect()}
    for g in ("hot", "a", "b"):
        vals = [v for k, v in rows if k == g and v is not None]
        assert got[g] == pytest.approx(float(np.quantile(vals, 0.9)))


def test_grouped_winsorize_caps_each_group(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("x", 1000.0), ("y", 5.0), ("y", None)], "g string, w double")
    out = sorted((r.g, r.c) for r in winsorize(df, "w", 0.99, out_col="c", by=["g"]).collect())
    assert out == [("x", 1.0), ("x", 2.0), ("x", pytest.approx(980.04)), ("y", 5.0), ("y", 5.0)]
