"""Percentiles by selection: scans, proof of the position, bad sketches."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.operators import quantile as Q


def frame(spark, values, parts=4):
    return spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)


def exact(values, ps):
    return [float(np.percentile(np.array(values), 100 * p)) for p in ps]


PS = [0.0, 0.01, 0.5, 0.77, 0.99, 1.0]


@pytest.mark.parametrize("kind", ["normal", "ties", "two", "one", "wide"])
def test_many_percentiles(spark, kind):
    rng = random.Random(1)
    values = {
        "normal": [rng.gauss(0, 1) for _ in range(5000)],
        "ties": [float(rng.choice([1, 1, 1, 2, 3, 1000])) for _ in range(3000)],
        "two": [1.0, 2.0],
        "one": [7.0],
        "wide": [rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300) for _ in range(2000)],
    }[kind]
    assert Q.percentiles_cont(frame(spark, values), "v", PS) == pytest.approx(exact(values, PS), rel=1e-12)


def test_three_percentiles_cost_two_scans(spark):
    scans = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    rng = random.Random(2)
    values = [rng.random() for _ in range(4000)]
    seen = frame(spark, values).mapInArrow(count, "v double")
    assert Q.percentiles_cont(seen, "v", [0.1, 0.5, 0.99]) == pytest.approx(exact(values, [0.1, 0.5, 0.99]), rel=1e-12)
    assert scans.value == 2 * len(values)


@pytest.mark.parametrize("wrong", [-1e9, 0.0, 0.2, 1e9])
def test_a_bad_sketch_still_gives_the_exact_value(spark, monkeypatch, wrong):
    """Every cut that the sketch returns is wrong; counts decide."""
    rng = random.Random(3)
    values = [rng.gauss(0, 1) for _ in range(3000)]
    real = F.percentile_approx
    monkeypatch.setattr(Q.F, "percentile_approx", lambda c, ps, a: F.transform(real(c, ps, 10), lambda x: F.lit(wrong)))
    monkeypatch.setattr(Q, "SMALL", 50)  # and cells are too large to be counted by value
    assert Q.percentiles_cont(frame(spark, values), "v", PS) == pytest.approx(exact(values, PS), rel=1e-12)
    by = frame(spark, values).withColumn("g", (F.col("v") > 1).cast("int"))
    got = {r.g: (r.a, r.b) for r in Q.percentiles_cont_by(by, ["g"], "v", {"a": 0.3, "b": 0.99}).collect()}
    for g in (0, 1):
        own = [v for v in values if (v > 1) == g]
        assert got[g] == pytest.approx(tuple(exact(own, [0.3, 0.99])), rel=1e-12)


def test_infinite_and_missing_values(spark):
    inf = float("inf")
    values = [-inf, -inf, 1.0, 2.0, 3.0, inf]
    rows = [(v,) for v in values] + [(None,), (float("nan"),)]
    got = Q.percentiles_cont(spark.createDataFrame(rows, "v double"), "v", [0.0, 0.4, 0.6, 1.0])
    assert got == [-inf, 1.0, 2.0, inf]
    assert Q.percentiles_cont(spark.createDataFrame([(None,)], "v double"), "v", [0.5]) == [None]
    with pytest.raises(ValueError):
        Q.percentiles_cont(frame(spark, [1.0]), "v", [1.5])


def test_groups_and_the_null_group(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.random(), 0.5])) for _ in range(3000)] + [("c", 1.0), ("d", None)]
    got = {r.g: (r.lo, r.hi) for r in Q.percentiles_cont_by(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"lo": 0.25, "hi": 0.99}).collect()}
    want = {g: tuple(exact([v for k, v in rows if k == g], [0.25, 0.99])) for g in ("a", "b", None, "c")}
    assert got.keys() == want.keys() and all(got[g] == pytest.approx(want[g], rel=1e-12) for g in want)
