"""End-to-end run: land -> raw gate -> models -> marts -> tests -> summary.

The phases run in the reference order, and the raw gate stops the run before
any model is built.  Every layer is a table under one warehouse root (a
shared folder):

* ``raw``  -- Parquet partitioned by ``survey_year``, with its ledger
  (``raw_ledger``: file, rows and check counters of each loaded year);
* ``intermediate/enriched`` -- staging + flags + risk decoded once and
  written once (partitioned by year); every mart reads only its columns
  from it, instead of re-decoding the raw layer per mart;
* ``marts/<name>`` -- the four marts and the weight diagnostics;
* ``checks/...`` -- check results and, per failing test, its failing rows.

The models of a run replace all requested years in all layers at once
(``sources.commit``): a year that yields no row leaves no row, and a run killed
before its commit leaves every layer as it was.  Writing the layers cuts
lineage: a lost executor re-reads files instead of recomputing from the raw scan.

The raw gate reads no rows: the counters of its checks are observed while the
raw layer is written and kept in the ledger.  Only a suite that asks for other
counters scans the raw table.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratiform.operators.checks import ROWS, WARN, Check, counters, gate, judge, run_data_tests, run_expectations, store_all_failures
from stratiform.operators.weights import survey_weights
from stratiform.plans import models as M
from stratiform.plans import suites as S
from stratiform.schema import LOADED_AT, SOURCE_VARIABLES, YEAR, normalise_name
from stratiform.session import tune_session
from stratiform.sources import ingest, landing
from stratiform.sources.commit import Folders, YearCommit, recover
from stratiform.sources.seeds import state_codes
from stratiform.sources.xpt import read_layout, read_xpt

SINGULAR = "singular"
RECORD_BITS = 40
#: The order of the marts as stored, inside a year.
STORED_ORDER = {
    "fct_diabetes_prevalence": ["state_abbr", "age_group", "race_ethnicity"],
    "fct_diabetes_risk_factors": ["diabetes_category"],
    "fct_survey_weighted_estimates": ["state_abbr"],
}


@dataclass
class PipelineConfig:
    warehouse: str
    years: list[int] = field(default_factory=lambda: list(S.DEFAULT_YEARS))
    landing_dir: str | None = None
    skip_landing: bool = False
    force: bool = False
    min_rows: int = S.MIN_ROWS_PER_YEAR
    max_rows: int = S.MAX_ROWS_PER_YEAR
    min_file_bytes: int = landing.MIN_FILE_BYTES
    min_cell: int = M.MIN_CELL
    raw_suite: list[Check] | None = None  # default: the reference raw suite
    hash_files: bool = True  # record size + SHA-256 of each loaded file

    def path(self, *parts: str) -> str:
        return "/".join([self.warehouse.rstrip("/"), *parts])


def raw_suite(cfg: PipelineConfig) -> list[Check]:
    return cfg.raw_suite or S.raw_expectations(tuple(cfg.years), cfg.min_rows, cfg.max_rows)


def land(spark: SparkSession, cfg: PipelineConfig) -> list[int]:
    """Load the requested yearly files into the raw layer; returns loaded years.

    The new years are scanned once: written by one job, and counted for the
    gate while they are written.  Data, column record, file record and ledger
    are committed together.
    """
    raw_path = cfg.path("raw")
    recover(spark, cfg.warehouse)
    files = landing.listing(spark, cfg.landing_dir, min_bytes=cfg.min_file_bytes)  # names only
    chosen = landing.files_to_load(spark, files, cfg.years, ingest.loaded_years(spark, raw_path), cfg.force)
    todo = sorted(chosen)
    if not todo:
        return todo
    paths = [chosen[y] for y in todo]
    swap = YearCommit(spark, cfg.warehouse, todo)
    known = {r["year"]: r for r in files.where(F.col("path").isin(paths)).collect()}  # one row a file
    digests: dict[int, str] = {}
    if cfg.hash_files:  # provenance: size and SHA-256 of the files being loaded, and of no others
        hashed = landing.manifest(spark, cfg.landing_dir, min_bytes=cfg.min_file_bytes, paths=paths)
        swap.write(hashed, "checks/landing_manifest", by="year")
        digests = {r["year"]: r["sha256"] for r in swap.read("checks/landing_manifest").collect()}
    stamp = ingest.load_stamp()
    frames, seen = [], {}
    for year in todo:
        # Years are told apart by file, so each is observed by itself: a row
        # passes only its own year's counters.
        frame = read_xpt(spark, chosen[year], columns=SOURCE_VARIABLES, with_record_no=True)
        projected, _missing = ingest.project_allowlist(frame)
        stamped = ingest.describe(ingest.add_metadata(projected, year, stamp))  # comments travel in the Parquet schema
        wanted = counters(raw_suite(cfg), set(stamped.columns))
        seen[year] = Observation(f"raw_{year}_{uuid.uuid4().hex}"), list(wanted)
        frames.append(stamped.observe(seen[year][0], *[F.count_if(c).alias(f"c{i}") for i, c in enumerate(wanted.values())]))
    swap.write(ingest.unify_years(frames), "raw")
    ledger = []
    for year in todo:
        observed, keys = seen[year]
        counts = {key: observed.get[f"c{i}"] for i, key in enumerate(keys)}
        ledger.append((year, chosen[year], known[year]["length"], digests.get(year), counts[ROWS], stamp, counts))
    swap.write(spark.createDataFrame(ledger, ingest.LEDGER_SCHEMA), "raw_ledger")
    headers = {y: [normalise_name(v.name) for v in read_layout(chosen[y]).variables] for y in todo}
    swap.write(ingest.column_rows(spark, headers), "raw_columns")
    swap.commit()
    return todo


def raw_results(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The raw suite for every requested year: from the ledger's counters, or
    by one pass over the raw table where they do not cover the suite."""
    raw_path, suite = cfg.path("raw"), raw_suite(cfg)
    raw = ingest.read_raw(spark, raw_path, cfg.years)
    groups, absent = [(y,) for y in cfg.years], []
    if Folders(spark, raw_path).exists(ingest.columns_path(raw_path)):
        absent = ingest.absent_columns(spark, raw_path, cfg.years)
    ledger = ingest.read_ledger(spark, raw_path, cfg.years)
    if ledger is not None:
        wanted = counters(suite, set(raw.columns)).keys()
        if all(wanted <= r["counts"].keys() for r in ledger.select("counts").collect()):  # one row a year
            return judge(ledger.select(YEAR, "counts"), suite, set(raw.columns), [YEAR], groups, absent)
    return run_expectations(raw, suite, by=[YEAR], groups=groups, absent=absent)


def raw_gate(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Evaluate and store the raw suite, then gate: a year without rows or a
    file without a column fails."""
    raw_results(spark, cfg).write.mode("overwrite").parquet(cfg.path("checks", "raw_expectations"))
    stored = spark.read.parquet(cfg.path("checks", "raw_expectations"))
    gate(stored, "raw expectations")
    return stored


def respondent_id(year: Column, record_no: Column) -> Column:
    """Year above, record number below: unique for 2**40 records a year, an
    error beyond."""
    fits = record_no.between(0, (1 << RECORD_BITS) - 1)
    packed = F.shiftleft(year.cast("bigint"), RECORD_BITS) + record_no
    return F.when(fits, packed).otherwise(F.raise_error(F.lit("record number beyond 2**40")).cast("bigint"))


def build_models(spark: SparkSession, cfg: PipelineConfig) -> dict[str, str]:
    raw = ingest.read_raw(spark, cfg.path("raw"), cfg.years)
    if "respondent_id" not in raw.columns:
        raw = raw.withColumn("respondent_id", respondent_id(F.col(YEAR), F.col("record_no")))
    staged = M.staging(raw, state_codes(spark))
    swap = YearCommit(spark, cfg.warehouse, cfg.years)
    swap.write(M.enrich(staged), "intermediate/enriched")
    rich = swap.read("intermediate/enriched")
    outputs = {
        "dim_respondent_demographics": M.dim_demographics(rich),
        "fct_diabetes_prevalence": M.prevalence(rich, min_cell=cfg.min_cell, sort=False),
        "fct_diabetes_risk_factors": M.risk_factors(rich, sort=False),
        "fct_survey_weighted_estimates": M.state_year_estimates(rich, sort=False),
        "int_survey_weights": survey_weights(rich),
    }
    # The marts are independent jobs over the same table: submit them together
    # so their tasks share the cluster instead of running one after another.
    with ThreadPoolExecutor(max_workers=len(outputs)) as pool:
        futures = [pool.submit(swap.write, df, f"marts/{name}", order=STORED_ORDER.get(name)) for name, df in outputs.items()]
        for fut in futures:
            fut.result()
    swap.commit()
    return {"enriched": cfg.path("intermediate", "enriched"), **{name: cfg.path("marts", name) for name in outputs}}


def singular_tests(rich: DataFrame, prev: DataFrame) -> dict[str, DataFrame]:
    """Tests that are queries: their rows are the failures."""
    return {
        "weights_sum_to_population": M.weights_outside(rich, *S.WEIGHT_POPULATION_RANGE),
        "prevalence_reasonable": M.prevalence_outside(prev, *S.PREVALENCE_RANGE),
    }


def _singular_results(failures: dict[str, DataFrame]) -> DataFrame:
    parts = [
        rows.agg(F.count(F.lit(1)).alias("n_failures")).select(
            F.lit(SINGULAR).alias("model"), F.lit(name).alias("test_name"), F.lit("query").alias("kind"),
            F.lit(None).cast("string").alias("column_name"), "n_failures", (F.col("n_failures") == 0).alias("passed"),
            F.lit(WARN).alias("severity"),
        )
        for name, rows in failures.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def test_models(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Warn-only data tests over the requested years; failing rows stored per
    test, and the stored rows of tests that pass now removed."""
    rich = ingest.read_raw(spark, cfg.path("intermediate", "enriched"), cfg.years)
    prev = ingest.read_raw(spark, cfg.path("marts", "fct_diabetes_prevalence"), cfg.years)
    suites = {"stg_respondents": S.staging_tests(tuple(cfg.years)), "int_diabetes_flags": S.flags_tests(),
              "int_metabolic_risk": S.risk_tests()}
    results = run_data_tests(rich, suites).unionByName(
        run_data_tests(prev, S.prevalence_tests(), "fct_diabetes_prevalence")
    )
    singular = singular_tests(rich, prev)
    results = results.unionByName(_singular_results(singular))
    results.write.mode("overwrite").parquet(cfg.path("checks", "model_tests"))
    stored = spark.read.parquet(cfg.path("checks", "model_tests"))
    root, folders = cfg.path("checks", "failures"), Folders(spark, cfg.warehouse)
    failed: dict[str, set[str]] = {}
    for row in stored.select("model", "test_name", "passed").collect():  # one row a test
        folders.delete(f"{root}/{row['model']}/{row['test_name']}")
        if not row["passed"]:
            failed.setdefault(row["model"], set()).add(row["test_name"])
    for name in failed.get(SINGULAR, ()):
        singular[name].write.mode("overwrite").parquet(f"{root}/{SINGULAR}/{name}")
    for frame, of in ((rich, suites), (prev, {"fct_diabetes_prevalence": S.prevalence_tests()})):
        store_all_failures(frame, {m: [c for c in cs if c.name in failed.get(m, ())] for m, cs in of.items()}, root)
    gate(stored, "model tests")  # all warn: never raises, returns the failures
    return stored


def summary(spark: SparkSession, cfg: PipelineConfig, tests: DataFrame) -> DataFrame:
    """One-row run summary: years, total rows, rows per year, tests passed."""
    raw = ingest.read_raw(spark, cfg.path("raw"), cfg.years)
    per_year = raw.groupBy(YEAR).agg(F.count(F.lit(1)).alias("n"))
    rows = per_year.agg(
        F.sort_array(F.collect_list(YEAR)).alias("years"),
        F.sum("n").cast("bigint").alias("total_rows"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(YEAR), F.col("n"))))).alias("rows_per_year"),
    )
    passed = tests.agg(F.min(F.col("passed").cast("int")).alias("ok")).collect()[0]["ok"]
    return rows.withColumn("tests_passed", F.lit(passed is None or passed == 1))


def register_views(spark: SparkSession, cfg: PipelineConfig) -> list[str]:
    """Temp views over the written layers (the reference's views/tables), for SQL.

    ``stg_respondents``, ``int_diabetes_flags`` and ``int_metabolic_risk`` are
    projections of the enriched table; marts and check results are their own
    tables.  Views are lazy: nothing is computed until queried.
    """
    rich = ingest.read_raw(spark, cfg.path("intermediate", "enriched"))
    views = {
        "raw_all": ingest.read_raw(spark, cfg.path("raw")),
        "stg_respondents": rich.select("respondent_id", *M.STAGED_COLUMNS, "state_abbr", "state_name"),
        "int_diabetes_flags": rich.select(*M.FLAG_COLUMNS),
        "int_metabolic_risk": rich.select(*M.RISK_COLUMNS),
        "raw_expectations": spark.read.parquet(cfg.path("checks", "raw_expectations")),
        "model_tests": spark.read.parquet(cfg.path("checks", "model_tests")),
    }
    for name in ("dim_respondent_demographics", "fct_diabetes_prevalence", "fct_diabetes_risk_factors",
                 "fct_survey_weighted_estimates", "int_survey_weights"):
        views[name] = ingest.read_raw(spark, cfg.path("marts", name))
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The whole run in phase order; raises ``CheckFailed`` at the raw gate."""
    tune_session(spark)
    recover(spark, cfg.warehouse)
    if not cfg.skip_landing:
        land(spark, cfg)
    raw_gate(spark, cfg)
    build_models(spark, cfg)
    tests = test_models(spark, cfg)
    out = summary(spark, cfg, tests)
    out.write.mode("overwrite").parquet(cfg.path("checks", "run_summary"))
    register_views(spark, cfg)
    return spark.read.parquet(cfg.path("checks", "run_summary"))
