"""Property tests: estimators against a plain-Python computation."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratiform.functions import estimators as E

rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c"]),
        st.one_of(st.none(), st.booleans()),
        st.one_of(st.none(), st.integers(min_value=0, max_value=1000).map(float)),
        st.one_of(st.none(), st.integers(min_value=0, max_value=5)),
    ),
    min_size=1,
    max_size=40,
)


def expected(group):
    total = sum(w for _, _, w, _ in group if w is not None)
    # SQL sum skips NULL terms and is NULL when every term is NULL
    terms = [(w if y else 0.0) for _, y, w, _ in group]
    known = [t for t in terms if t is not None]
    hit = sum(known) if known else None
    num = sum(x * w for _, _, w, x in group if x is not None and w is not None)
    den = sum(w for _, _, w, x in group if x is not None and w is not None)
    has_w = any(w is not None for _, _, w, _ in group)
    has_xw = any(x is not None and w is not None for _, _, w, x in group)
    return (
        (hit / total) if has_w and total != 0 and hit is not None else None,
        hit,
        (num / den) if has_xw and den != 0 else None,
    )


@settings(max_examples=15, deadline=None)
@given(rows)
def test_estimators_match_python(spark, data):
    df = spark.createDataFrame(data, "g string, y boolean, w double, x int")
    out = {
        r.g: r
        for r in df.groupBy("g")
        .agg(
            E.weighted_proportion(F.col("y"), "w").alias("p"),
            E.weighted_count(F.col("y"), "w").alias("c"),
            E.weighted_mean("x", "w").alias("m"),
        )
        .collect()
    }
    for g in {d[0] for d in data}:
        p, c, m = expected([d for d in data if d[0] == g])
        r = out[g]
        assert (r.p is None) == (p is None) and (p is None or abs(r.p - p) < 1e-12)
        assert r.c == c
        assert (r.m is None) == (m is None) and (m is None or abs(r.m - m) < 1e-9)
        if r.p is not None:
            assert 0.0 <= r.p <= 1.0


codes = st.lists(
    st.one_of(st.none(), st.integers(min_value=-3, max_value=20).map(float),
              st.integers(min_value=-30, max_value=200).map(lambda x: x / 10)),
    min_size=1, max_size=30,
)


@settings(max_examples=10, deadline=None)
@given(codes)
def test_decode_rounds_half_even_then_looks_up(spark, values):
    from stratiform.functions import codebooks as D

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c double")
    got = {r.i: (r.a, r.s) for r in df.select("i", D.decode("c", D.AGE_GROUP).alias("a"),
                                             D.decode("c", D.SEX, D.UNKNOWN).alias("s")).collect()}
    for i, v in enumerate(values):
        code = None if v is None else int(round(v))  # Python round() is half-to-even
        assert got[i] == (D.AGE_GROUP.get(code), D.SEX.get(code, D.UNKNOWN))
