"""Incremental landing of new yearly files with Structured Streaming.

The reference refreshes once a year: new year files appear, years already
loaded are skipped, a forced reload replaces a year.  Here the landing
folder is a streaming ``binaryFile`` source (paths and sizes only; file
contents are not read by the stream) run with ``trigger(availableNow=True)``:
each run processes exactly the files that arrived since the previous run,
and that progress lives in the checkpoint location on shared storage.

Every micro-batch holds one row per new file (a handful per year).  Each
file is loaded by the splittable XPT scan and replaces its whole year by a
two-phase commit, so a micro-batch replayed after a failure rewrites the
same years: the sink is idempotent.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from stratiform.schema import RAW_VARIABLES, SOURCE_VARIABLES
from stratiform.sources import ingest, landing
from stratiform.sources.xpt import read_xpt

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
_YEAR = re.compile(landing.YEAR_FILE_PATTERN)


def _year_of(path: str) -> int | None:
    m = _YEAR.search(path.rsplit("/", 1)[-1])
    return int(m.group(1)) if m else None


def land_new_files(
    spark: SparkSession,
    landing_dir: str,
    raw_path: str,
    checkpoint_location: str,
    years: list[int] | None = None,
    min_bytes: int = landing.MIN_FILE_BYTES,
) -> list[int]:
    """Load every yearly file that landed since the last run; returns the years loaded."""
    loaded: list[int] = []

    def load_batch(files: DataFrame, batch_id: int) -> None:
        for row in files.collect():  # one row per newly landed file
            year = _year_of(row["path"])
            if year is None or (years and year not in years):
                continue
            if row["length"] < min_bytes:
                raise ValueError(f"{row['path']}: {row['length']} bytes, below the minimum {min_bytes}")
            frame = read_xpt(spark, row["path"], columns=SOURCE_VARIABLES, with_record_no=True)
            projected, missing = ingest.project_allowlist(frame)
            ingest.write_raw(ingest.add_metadata(projected, year), raw_path, years=[year])
            ingest.record_columns(spark, {year: sorted(set(RAW_VARIABLES) - set(missing))}, raw_path)
            loaded.append(year)

    query = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", "*.[xX][pP][tT]")
        .load(landing_dir)
        .select("path", "length")
        .writeStream.foreachBatch(load_batch)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint_location)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return sorted(loaded)
