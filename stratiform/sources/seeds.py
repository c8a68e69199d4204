"""Seed lookups: state codes and the variable dictionary.

The packaged CSVs live on the driver only, so by default they are parsed on
the driver into a small local relation (54 and 25 rows, fixed size) that the
planner embeds and broadcasts.  A user-supplied seed on shared storage is
read with ``spark.read.csv`` and an explicit schema instead.
"""

from __future__ import annotations

import csv
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.schema import STATE_CODES_SCHEMA, VARIABLE_LABELS_SCHEMA

STATE_CODES_FILE = "state_codes.csv"
VARIABLE_LABELS_FILE = "variable_labels.csv"


def _packaged_rows(name: str) -> list[list[str]]:
    text = resources.files("stratiform.sources").joinpath("seeds", name).read_text(encoding="utf-8")
    lines = [ln for ln in text.splitlines() if ln and not ln.startswith("#")]
    rows = list(csv.reader(lines))
    return rows[1:]


def packaged_state_codes() -> list[tuple[int, str, str]]:
    return [(int(r[0]), r[1], r[2]) for r in _packaged_rows(STATE_CODES_FILE)]


def _values_relation(spark: SparkSession, rows: list[list[str]], schema) -> DataFrame:
    """A JVM-side local relation (``VALUES``): no Python RDD, no Python worker."""
    def lit(v: str) -> str:
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    names = ", ".join(schema.fieldNames())
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def _read(spark: SparkSession, path: str | None, name: str, schema) -> DataFrame:
    if path is not None:
        return (
            spark.read.schema(schema)
            .option("header", True)
            .option("comment", "#")
            .option("quote", '"')
            .option("encoding", "UTF-8")
            .csv(path)
        )
    return _values_relation(spark, _packaged_rows(name), schema)


def state_codes_raw(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The state seed as stored: every column text."""
    return _read(spark, path, STATE_CODES_FILE, STATE_CODES_SCHEMA)


def state_codes(spark: SparkSession, path: str | None = None) -> DataFrame:
    """State lookup with the FIPS code cast back to INT for joining."""
    return state_codes_raw(spark, path).select(
        F.col("fips_code").cast("int").alias("fips_code"), "state_abbr", "state_name"
    )


def variable_labels(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Data dictionary of the kept variables (joinable on ``raw_column``)."""
    return _read(spark, path, VARIABLE_LABELS_FILE, VARIABLE_LABELS_SCHEMA)
