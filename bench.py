"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_QUERIES (comma list), BENCH_END_TO_END (1/0:
also time one end-to-end run, reported outside the query sum).  Each query is executed in full through the
``noop`` sink (every row computed, nothing collected on the driver); the
reported time is the median over the runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "weighted_proportion",
    "stg_frame",
    "normalized_weights",
    "fct_prevalence",
    "fct_risk_factors",
    "fct_state_year",
    "trend_by_group",
    "dense_row_id",
    "winsorize",
    "percentile",
    "weighted_proportion_null_outcome",
]


def bench_end_to_end(spark, sf_dir: str, scratch: str) -> dict:
    """End-to-end run (land XPT -> raw gate -> enriched -> 5 marts -> tests ->
    summary) over yearly XPT files made from the sf respondent frame.  File
    preparation is not timed; the raw suite runs at warn severity because the
    derived frame carries deliberate defects and the fixed row-count range
    is sized for real yearly files."""
    from dataclasses import replace

    import numpy as np

    sys.path.insert(0, str(Path(__file__).resolve().parent / "tests"))
    from xpt_writer import write_xpt_numeric

    from stratiform.operators.checks import WARN
    from stratiform.plans import suites
    from stratiform.plans.frame import raw_frame
    from stratiform.plans.pipeline import PipelineConfig, run_pipeline
    from stratiform.schema import SOURCE_VARIABLES, normalise_name
    from stratiform.sources.landing import file_path

    landing_dir = os.path.join(scratch, "landing")
    os.makedirs(landing_dir, exist_ok=True)
    pdf = raw_frame(spark, sf_dir).toPandas()
    years = sorted(int(y) for y in pdf["survey_year"].unique())
    for year, part in pdf.groupby("survey_year"):
        cols = {v: part[normalise_name(v)].to_numpy(dtype=np.float64, na_value=np.nan) for v in SOURCE_VARIABLES}
        write_xpt_numeric(file_path(int(year), landing_dir), cols)
    suite = [replace(c, severity=WARN) for c in suites.raw_expectations(tuple(years))]
    cfg = PipelineConfig(warehouse=os.path.join(scratch, "warehouse"), landing_dir=landing_dir, years=years,
                         min_file_bytes=1, raw_suite=suite)
    t0 = time.perf_counter()
    summary = run_pipeline(spark, cfg).collect()[0]
    return {"sec": round(time.perf_counter() - t0, 3), "rows": int(summary["total_rows"]), "years": years}


def main() -> None:
    from pyspark.sql import SparkSession

    from stratiform.plans import registry

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="stratiform-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stratiform-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", scratch)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    qs = registry.queries()
    timings: dict[str, float] = {}
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    for name in only or HEADLINE:
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                samples.append(dt)
            if os.environ.get("BENCH_VERBOSE"):
                print(name, i, round(dt, 3), file=sys.stderr, flush=True)
        timings[name] = round(statistics.median(samples), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    end_to_end = None
    if os.environ.get("BENCH_END_TO_END", "1") == "1":
        try:  # optional extra: never lose the query timings over it
            end_to_end = bench_end_to_end(spark, sf_dir, scratch)
        except Exception as exc:  # noqa: BLE001
            end_to_end = {"error": f"{type(exc).__name__}: {str(exc)[:200]}"}
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf,
                "cpus": int(cpus),
                "runs": runs,
                "end_to_end_run": end_to_end,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
