"""Whole years replaced in two phases, the ledger, and what a run reads."""

from __future__ import annotations

import glob
import json
import os
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratiform.operators import checks
from stratiform.operators.checks import WARN, Check
from stratiform.plans import pipeline as P
from stratiform.plans import suites as S
from stratiform.schema import SOURCE_VARIABLES, YEAR
from stratiform.sources import ingest, landing
from stratiform.sources.commit import Folders, YearCommit, journal_path, recover
from stratiform.sources.xpt import read_layout, read_xpt
from xpt_writer import write_xpt

SCHEMA = "v int, survey_year int"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(spark, path):
    return sorted(map(tuple, ingest.read_raw(spark, path).select("survey_year", "v").collect()))


def test_a_year_without_rows_is_gone(spark, scratch_dir):
    path = f"{scratch_dir}/t"
    ingest.write_raw(frame(spark, (1, 2021), (2, 2022)), path, years=[2021, 2022])
    ingest.write_raw(frame(spark, (3, 2021)), path, years=[2021, 2022])
    assert rows(spark, path) == [(2021, 3)]
    ingest.write_raw(frame(spark), path, years=[2021])
    assert rows(spark, path) == []  # no file is left, the schema is
    ingest.write_raw(frame(spark, (4, 2023)), path, years=[2023])
    assert rows(spark, path) == [(2023, 4)]
    with pytest.raises(ValueError, match="2024"):
        ingest.write_raw(frame(spark, (5, 2024)), path, years=[2023])
    assert rows(spark, path) == [(2023, 4)]


def staged(spark, root):
    swap = YearCommit(spark, root, [2021, 2022])
    swap.write(frame(spark, (9, 2021)), "a")
    swap.write(frame(spark, (9, 2022)), "b/c")
    return swap


@pytest.fixture()
def two_tables(spark, scratch_dir):
    for table in ("a", "b/c"):
        ingest.write_raw(frame(spark, (1, 2021), (2, 2022), (3, 2023)), f"{scratch_dir}/{table}", years=[2021, 2022, 2023])
    return scratch_dir


OLD = [(2021, 1), (2022, 2), (2023, 3)]


def test_a_run_killed_before_its_commit_changes_nothing(spark, two_tables):
    staged(spark, two_tables)
    assert not recover(spark, two_tables)
    assert rows(spark, f"{two_tables}/a") == OLD and rows(spark, f"{two_tables}/b/c") == OLD
    staged(spark, two_tables).commit()
    assert rows(spark, f"{two_tables}/a") == [(2021, 9), (2023, 3)] and rows(spark, f"{two_tables}/b/c") == [(2022, 9), (2023, 3)]


@pytest.mark.parametrize("moves", [0, 1, 2, 3, 4, 5])
def test_a_run_killed_inside_its_swap_is_finished(spark, two_tables, monkeypatch, moves):
    swap = staged(spark, two_tables)
    swap.prepare()
    done = []

    def cut(self, *args, step=None):
        if len(done) >= moves:
            raise KeyboardInterrupt
        done.append(args)
        return step(self, *args)

    with monkeypatch.context() as m:
        for name in ("delete", "move"):
            m.setattr(Folders, name, lambda self, *a, f=getattr(Folders, name): cut(self, *a, step=f))
        with pytest.raises(KeyboardInterrupt):
            recover(spark, two_tables)
    assert os.path.exists(journal_path(two_tables))
    assert recover(spark, two_tables) and not recover(spark, two_tables)
    assert rows(spark, f"{two_tables}/a") == [(2021, 9), (2023, 3)] and rows(spark, f"{two_tables}/b/c") == [(2022, 9), (2023, 3)]


def test_a_second_writer_is_refused(spark, two_tables):
    first, second = staged(spark, two_tables), staged(spark, two_tables)
    first.prepare()
    with pytest.raises(FileExistsError):
        second.prepare()
    second.abandon()
    assert recover(spark, two_tables)


def year_file(folder, year, n=30, weight=100.0, drop=()):
    cols = {v: [float(1 + i % 4) for i in range(n)] for v in SOURCE_VARIABLES if v not in drop}
    cols["_LLCPWT"] = [weight] * n
    write_xpt(landing.file_path(year, folder), cols)


def config(folder, warehouse, **kw):
    suite = [replace(c, severity=WARN) for c in S.raw_expectations(min_rows=1, max_rows=1000)]
    return P.PipelineConfig(warehouse=warehouse, landing_dir=folder, min_file_bytes=1, min_cell=5, raw_suite=suite, years=[2022, 2023], **kw)


LAYERS = ["intermediate/enriched", "marts/dim_respondent_demographics", "marts/fct_diabetes_prevalence", "marts/fct_diabetes_risk_factors", "marts/fct_survey_weighted_estimates", "marts/int_survey_weights"]


def years_of(spark, cfg, layer):
    return {r[0] for r in ingest.read_raw(spark, cfg.path(layer)).select("survey_year").distinct().collect()}


def test_rerun_that_leaves_a_year_empty(spark, scratch_dir):
    files = f"{scratch_dir}/in"
    os.makedirs(files)
    for year in (2022, 2023):
        year_file(files, year)
    cfg = config(files, f"{scratch_dir}/wh")
    P.run_pipeline(spark, cfg)
    assert all(years_of(spark, cfg, layer) == {2022, 2023} for layer in LAYERS)
    year_file(files, 2023, weight=0.0)  # no respondent stays after the weight filter
    cfg.force = True
    P.run_pipeline(spark, cfg)
    assert all(years_of(spark, cfg, layer) == {2022} for layer in LAYERS)
    assert years_of(spark, cfg, "raw") == {2022, 2023}
    cfg.force = False
    before = {layer: sorted(map(str, ingest.read_raw(spark, cfg.path(layer)).collect())) for layer in LAYERS}
    P.build_models(spark, cfg)
    assert before == {layer: sorted(map(str, ingest.read_raw(spark, cfg.path(layer)).collect())) for layer in LAYERS}


def test_gate_reads_the_ledger_only(spark, scratch_dir):
    files = f"{scratch_dir}/in"
    os.makedirs(files)
    year_file(files, 2022, n=40, drop=("PREDIAB2",))
    year_file(files, 2023, n=50)
    cfg = config(files, f"{scratch_dir}/wh")
    P.land(spark, cfg)
    cfg.years = [2022, 2023, 2099]
    raw = ingest.read_raw(spark, cfg.path("raw"), cfg.years)
    absent = ingest.absent_columns(spark, cfg.path("raw"), cfg.years)
    scanned = checks.run_expectations(raw, P.raw_suite(cfg), by=["survey_year"], groups=[(y,) for y in cfg.years], absent=absent)
    want = sorted(map(str, scanned.collect()))
    ledger = ingest.read_ledger(spark, cfg.path("raw"))
    assert {r.survey_year: r.n_rows for r in ledger.collect()} == {2022: 40, 2023: 50}
    assert all(len(r.sha256) == 64 and r.length > 0 for r in ledger.collect())
    for part in glob.glob(f"{cfg.path('raw')}/survey_year=*/*.parquet"):
        with open(part, "wb") as fh:  # any read of the rows would fail now
            fh.write(b"not parquet")
    assert sorted(map(str, P.raw_results(spark, cfg).collect())) == want and len(want) == 31 * 3
    assert ingest.loaded_years(spark, cfg.path("raw")) == {2022, 2023}
    assert P.land(spark, replace(cfg, years=[2022, 2023])) == []  # chosen without opening a data file
    cfg.raw_suite = [Check("other", "between", column="psu", min_value=0, max_value=9)]
    assert "FileScan" in P.raw_results(spark, cfg)._jdf.queryExecution().toString()  # a counter that was not taken needs the rows


def test_years_loaded_before_there_was_a_ledger(spark, scratch_dir):
    ingest.write_raw(frame(spark, (1, 2021), (2, 2022)), f"{scratch_dir}/raw")
    assert ingest.loaded_years(spark, f"{scratch_dir}/raw") == {2021, 2022}


def cut_file(folder, drop):
    year_file(folder, 2022, n=100)
    path = landing.file_path(2022, folder)
    with open(path, "rb") as fh:
        data = fh.read()
    with open(path, "wb") as fh:
        fh.write(data[:-drop])
    return path


@pytest.mark.parametrize("drop", [1, 79, 80, 5150, 160])
def test_a_file_cut_inside_a_record_is_an_error(spark, scratch_dir, drop):
    path = cut_file(scratch_dir, drop)
    with pytest.raises(ValueError, match="inside a record"):
        read_layout(path)
    with pytest.raises(Exception, match="inside a record"):
        read_xpt(spark, path).count()


def test_one_year_opens_one_file(spark, scratch_dir):
    year_file(scratch_dir, 2022)
    for name in ("LLCP2021.XPT", "LLCP2023.XPT", "notes.xpt"):
        with open(f"{scratch_dir}/{name}", "wb") as fh:
            fh.write(b"opening this fails")
    one = read_xpt(spark, scratch_dir, columns=["_STATE"], with_record_no=True, with_file_year=True, years=[2022, 2050])
    assert one.where("file_year = 2022").count() == 30 == one.count()
    assert spark.read.format("xpt").option("years", "2022").load(scratch_dir).agg(F.sum("_STATE")).first()[0] > 0
    with pytest.raises(Exception, match="not a SAS transport"):
        spark.read.format("xpt").schema(one.schema).load(scratch_dir).count()


def test_filters_leave_later_queries_whole(spark, scratch_dir):
    for year in (2021, 2022):
        year_file(scratch_dir, year)
    every = read_xpt(spark, scratch_dir, columns=["_STATE"], with_record_no=True, with_file_year=True)
    assert every.where("file_year = 2022 AND record_no < 5").count() == 5
    assert every.count() == 60 and every.where("record_no < 3").union(every).count() == 66


def test_record_ranges_cut_the_splits(spark, scratch_dir):
    year_file(scratch_dir, 2022, n=1000)
    some = lambda *records: read_xpt(spark, scratch_dir, columns=["_STATE"], with_record_no=True, partition_bytes=20_000, records=records)
    assert sorted(r.record_no for r in some(100, 130).collect()) == list(range(100, 130))
    assert some(100, 130).rdd.getNumPartitions() == 1 < some(0, 1000).rdd.getNumPartitions()
    assert some(990, 5000).count() == 10 and some(5, 5).count() == 0


def test_failing_rows_are_stored_by_one_scan(spark, scratch_dir):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (2, None, -2), (None, "c", 7)], "id int, s string, v int")
    suites = {"m": [Check("s_known", "not_null", column="s"), Check("v_low", "expression", expression="v > 0"), Check("v_high", "expression", expression="v < 6"), Check("fine", "expression", expression="v < 99")],
              "n": [Check("s_known", "accepted_values", column="s", values=("a",)), Check("id_unique", "unique", column="id")]}
    root = f"{scratch_dir}/failures"
    scans = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    checks.store_all_failures(df.mapInArrow(count, df.schema), {"m": suites["m"], "n": suites["n"][:1]}, root)
    assert scans.value == 4  # each row was read once, though three tests of it fail
    checks.store_all_failures(df, {"n": suites["n"][1:]}, root)
    got = {os.path.relpath(p, root): sorted(map(tuple, spark.read.parquet(p).collect()), key=str) for p in glob.glob(f"{root}/*/*")}
    want = {f"{m}/{c.name}": sorted(map(tuple, checks.failing_rows(df, c).collect()), key=str) for m, cs in suites.items() for c in cs if c.name != "fine"}
    assert got == want and not os.path.exists(f"{root}/_all")


def test_each_landed_file_has_its_own_task(spark):
    names = spark.createDataFrame([(f"/x/LLCP{y}.XPT",) for y in range(1990, 2020)], "path string")
    dealt = landing.one_task_each(names, "path")
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 30 and all(r["count"] == 1 for r in sizes)


def test_documented_columns():
    from stratiform.schema import RAW_COMMENTS

    assert {"ststr", "psu", "bmi5"} <= RAW_COMMENTS.keys()
    assert json.dumps(RAW_COMMENTS)


def test_clustered_files_hold_ranges_in_order(spark, scratch_dir):
    """Several files a year: sorted inside, ranges of the first column apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(2021 + i % 2, None if i % 41 == 0 else f"s{i * 37 % 53:02d}", i * 29 % 97) for i in range(4000)]
        swap = YearCommit(spark, scratch_dir, [2021, 2022])
        swap.write(spark.createDataFrame(rows, f"{YEAR} int, state string, n int").repartition(7), "mart", order=["state", "n"])
        swap.commit()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    last = lambda r: (r[0] is None, r[0] or "", r[1])  # noqa: E731 - NULLs last
    for year in (2021, 2022):
        files = [pq.ParquetFile(f).read(columns=["state", "n"]).to_pylist() for f in sorted(glob.glob(f"{scratch_dir}/mart/{YEAR}={year}/*.parquet"))]
        parts = [[(r["state"], r["n"]) for r in f] for f in files]
        assert len(parts) > 1 and all(p == sorted(p, key=last) for p in parts)
        states = [{s for s, _ in p} for p in parts]
        assert sum(map(len, states)) == len(set().union(*states))
        read = [r for p in parts for r in p]
        assert read == sorted(((s, n) for y, s, n in rows if y == year), key=last)
