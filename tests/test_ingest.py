"""Raw layer: names, metadata, allowlist drift, NaN, idempotent year overwrite,
seeds, landing manifest."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from stratiform.schema import RAW_VARIABLES, SOURCE_VARIABLES, normalise_name
from stratiform.sources import ingest, landing
from stratiform.sources.seeds import packaged_state_codes, state_codes, state_codes_raw, variable_labels


def test_name_normalisation_examples():
    given = {"_RFHYPE6": "rfhype6", "__X_Y_": "x_y_", "EDUCA": "educa", "psu": "psu", "_": ""}
    assert {c: normalise_name(c) for c in given} == given
    assert not any(c.startswith("_") for c in RAW_VARIABLES) and len(RAW_VARIABLES) == 25


def test_normalise_columns_on_frame(spark):
    df = spark.createDataFrame([], ", ".join(f"`{c}` double" for c in ["_BMI5", "_STATE", "DIABETE4", "_X_Y"]))
    assert ingest.normalise_columns(df).columns == ["bmi5", "state", "diabete4", "x_y"]


def test_add_metadata(spark):
    df = ingest.add_metadata(spark.range(3), 2019, loaded_at="2020-05-06T07:08:09+00:00")
    rows = df.collect()
    assert [(r.survey_year, r.loaded_at) for r in rows] == [(2019, "2020-05-06T07:08:09+00:00")] * 3
    assert all(r.loaded_at.endswith("+00:00") for r in ingest.add_metadata(spark.range(1), 2019).collect())
    assert dict(df.dtypes)["survey_year"] == "int"


def test_allowlist_drift_and_nan(spark):
    df = spark.createDataFrame([(float("nan"), 3.0, 9.0)], "`_LLCPWT` double, DIABETE4 double, EXTRA double")
    out, missing = ingest.project_allowlist(df)
    assert out.columns == RAW_VARIABLES
    assert "prediab2" in missing and "llcpwt" not in missing
    r = out.collect()[0]
    assert r.llcpwt is None and r.diabete4 == 3.0 and r.prediab2 is None


def test_unify_years_fills_missing_column(spark):
    a = spark.createDataFrame([(2021, 1.0)], "survey_year int, prediab2 double")
    b = spark.createDataFrame([(2022,)], "survey_year int")
    rows = sorted(ingest.unify_years([a, b]).collect())
    assert [tuple(r) for r in rows] == [(2021, 1.0), (2022, None)]


def test_partition_overwrite_is_idempotent(spark, scratch_dir):
    path = os.path.join(scratch_dir, "raw")
    y21 = spark.createDataFrame([(1.0, 2021), (2.0, 2021)], "llcpwt double, survey_year int")
    y22 = spark.createDataFrame([(3.0, 2022)], "llcpwt double, survey_year int")
    ingest.write_raw(y21, path)
    ingest.write_raw(y22, path)
    ingest.write_raw(y22, path)  # rerun replaces only 2022
    counts = {r.survey_year: r.n_rows for r in ingest.rows_per_year(ingest.read_raw(spark, path)).collect()}
    assert counts == {2021: 2, 2022: 1}
    assert ingest.read_raw(spark, path, [2022]).count() == 1


def test_state_seed(spark):
    rows = packaged_state_codes()
    assert len(rows) == 54 and rows[0] == (1, "AL", "Alabama") and rows[-1] == (78, "VI", "Virgin Islands")
    assert dict(state_codes_raw(spark).dtypes)["fips_code"] == "string"
    assert dict(state_codes(spark).dtypes)["fips_code"] == "int"


def test_variable_labels_joinable(spark):
    labels = variable_labels(spark)
    assert labels.count() == 25
    assert {r.source_variable for r in labels.collect()} == set(SOURCE_VARIABLES)


def test_seed_from_csv_path(spark, scratch_dir):
    p = os.path.join(scratch_dir, "states.csv")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("# comment\nfips_code,state_abbr,state_name\n1,AL,Alabama\n72,PR,\"Puerto Rico\"\n")
    assert sorted(tuple(r) for r in state_codes(spark, p).collect()) == [(1, "AL", "Alabama"), (72, "PR", "Puerto Rico")]


def test_landing_manifest_and_year_selection(spark, scratch_dir):
    for y, size in [(2021, 11), (2022, 5000)]:
        with open(landing.file_path(y, scratch_dir), "wb") as fh:
            fh.write(b"x" * size)
    with open(os.path.join(scratch_dir, "notes.txt"), "w") as fh:
        fh.write("hi")
    m = landing.manifest(spark, scratch_dir, min_bytes=1000)
    rows = {r.file_name: r for r in m.collect()}
    assert rows["LLCP2021.XPT"].sha256 == hashlib.sha256(b"x" * 11).hexdigest()
    assert not rows["LLCP2021.XPT"].large_enough and rows["LLCP2022.XPT"].large_enough
    assert not rows["notes.txt"].is_year_file
    loaded = spark.createDataFrame([(2021,)], "survey_year int")
    assert landing.years_to_load(spark, m, [2021, 2022], loaded) == [2022]
    with pytest.raises(ValueError):
        landing.years_to_load(spark, m, [2021, 2022], loaded, force=True)
    small = landing.listing(spark, scratch_dir, min_bytes=1)
    assert landing.years_to_load(spark, small, [2021, 2022], loaded, force=True) == [2021, 2022]
    with pytest.raises(FileNotFoundError):
        landing.years_to_load(spark, m, [2023], loaded)
    assert landing.file_path(2022, "/data/raw") == "/data/raw/LLCP2022.XPT"
    assert F is not None


def test_manifest_opens_only_the_named_files(spark, scratch_dir):
    for y, size in [(2021, 3000), (2022, 70000)]:
        with open(landing.file_path(y, scratch_dir), "wb") as fh:
            fh.write(bytes(range(256)) * (size // 256))
    every = {r.file_name: r.sha256 for r in landing.manifest(spark, scratch_dir, min_bytes=1).collect()}
    with open(landing.file_path(2022, scratch_dir), "rb") as fh:
        assert every["LLCP2022.XPT"] == hashlib.sha256(fh.read()).hexdigest() and len(every) == 2
    os.chmod(landing.file_path(2021, scratch_dir), 0)
    one = landing.manifest(spark, scratch_dir, min_bytes=1, paths=[landing.file_path(2022, scratch_dir)]).collect()
    assert [(r.year, r.sha256) for r in one] == [(2022, every["LLCP2022.XPT"])]


def test_small_lower_case_and_double_files(spark, scratch_dir):
    for name, size in [("LLCP2021.XPT", 11), ("llcp2024.xpt", 5000)]:
        with open(os.path.join(scratch_dir, name), "wb") as fh:
            fh.write(b"x" * size)
    files = landing.listing(spark, scratch_dir, min_bytes=1000)
    with pytest.raises(ValueError, match="below the minimum"):
        landing.years_to_load(spark, files, [2021, 2024])
    assert landing.files_to_load(spark, files, [2024])[2024].endswith("llcp2024.xpt")
    with open(os.path.join(scratch_dir, "LLCP2024.XPT"), "wb") as fh:
        fh.write(b"x" * 5000)
    with pytest.raises(ValueError, match="two files"):
        landing.files_to_load(spark, landing.listing(spark, scratch_dir, min_bytes=1000), [2024])


def test_recorded_columns(spark, scratch_dir):
    raw = os.path.join(scratch_dir, "raw")
    from stratiform.schema import RAW_VARIABLES

    ingest.record_columns(spark, {2021: RAW_VARIABLES, 2022: [c for c in RAW_VARIABLES if c != "insulin1"]}, raw)
    assert ingest.absent_columns(spark, raw, [2021, 2022]) == [(2022, "insulin1")]
    ingest.record_columns(spark, {2022: RAW_VARIABLES}, raw)  # a reload replaces its year only
    assert ingest.absent_columns(spark, raw, [2021, 2022]) == []
