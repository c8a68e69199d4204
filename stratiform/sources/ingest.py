"""Raw layer: allowlist projection, name normalisation, load metadata, sinks.

A yearly file becomes a ``survey_year`` partition of one Parquet table.  With
the list of ``years`` a write replaces whole years (``sources.commit``): a year
that yields no row any more is gone afterwards, other years are untouched.
Without it only the years that have rows are replaced.

The ledger (``<raw>_ledger``) holds one row a loaded year: its file, size and
digest, its rows, and the counters of the raw checks taken while it was
written.  Choosing years and judging the gate read the ledger, not the data.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.sources.commit import Folders, YearCommit, stored_schema
from stratiform.schema import LOADED_AT, RAW_COMMENTS, RAW_VARIABLES, YEAR, normalise_name


# Columns carried through the allowlist projection besides the variables.
CARRIED_COLUMNS = ("respondent_id", "record_no", YEAR, LOADED_AT)
# Carried but dropped from the raw layer: provenance columns of the scan.
SCAN_ONLY_COLUMNS = ("source_file",)


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename every column by the raw name rule (also names outside the allowlist)."""
    return df.withColumnsRenamed({c: normalise_name(c) for c in df.columns if normalise_name(c) != c})


def project_allowlist(
    df: DataFrame, allowlist: list[str] = RAW_VARIABLES, fill_missing: bool = True
) -> tuple[DataFrame, list[str]]:
    """Keep the allowlisted columns in allowlist order; report the missing ones.

    Input names may be source names (``_BMI5``) or normalised (``bmi5``).
    Missing columns become typed NULL columns when ``fill_missing`` so every
    year has the same schema; NaN in any double column becomes NULL (NaN would
    pass ``weight > 0`` and poison sums).
    """
    df = normalise_columns(df)
    present = set(df.columns)
    missing = [c for c in allowlist if c not in present]
    cols = []
    for c in allowlist:
        if c in present:
            cols.append(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c))
        elif fill_missing:
            cols.append(F.lit(None).cast("double").alias(c))
    extra = [c for c in df.columns if c in CARRIED_COLUMNS]
    return df.select(*cols, *extra), missing


def load_stamp() -> str:
    """The ``loaded_at`` value: current UTC time as ISO-8601 text."""
    return datetime.now(tz=UTC).isoformat()


def add_metadata(df: DataFrame, year: int, loaded_at: str | None = None) -> DataFrame:
    """Append ``survey_year`` (INT) and ``loaded_at`` (UTC ISO-8601 text)."""
    stamp = loaded_at or load_stamp()
    return df.withColumns({YEAR: F.lit(year).cast("int"), LOADED_AT: F.lit(stamp)})


def describe(df: DataFrame, comments: dict[str, str] = RAW_COMMENTS) -> DataFrame:
    """Attach column comments (the source declaration) as field metadata."""
    return df.withColumns(
        {c: F.col(c).alias(c, metadata={"comment": text}) for c, text in comments.items() if c in df.columns}
    )


def unify_years(frames: list[DataFrame]) -> DataFrame:
    """Union yearly frames by column name; absent columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_raw(df: DataFrame, path: str, mode: str = "overwrite", years: list[int] | None = None) -> None:
    """Write a year-partitioned table: replace ``years``, whether or not they
    have rows, or without that list only the years present.

    Dynamic partition overwrite is set on this write only (no session-wide
    setting, so concurrent writes from other threads are unaffected).
    """
    if years is not None:
        root, table = path.rstrip("/").rsplit("/", 1)
        swap = YearCommit(df.sparkSession, root, years)
        swap.write(df, table)
        swap.commit()
        return
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(path)


def read_raw(spark: SparkSession, path: str, years: list[int] | None = None) -> DataFrame:
    """The unified multi-year raw table; a year list prunes partitions."""
    schema = stored_schema(spark, path)
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if years:
        df = df.where(F.col(YEAR).isin(years))
    return df


def column_rows(spark: SparkSession, columns: dict[int, list[str]]) -> DataFrame:
    """Which allowlisted columns each year's file has."""
    rows = [(year, c, c in set(have)) for year, have in columns.items() for c in RAW_VARIABLES]
    return spark.createDataFrame(rows, f"{YEAR} int, column_name string, present boolean")


def record_columns(spark: SparkSession, columns: dict[int, list[str]], raw_path: str) -> None:
    """Store them beside the raw table, replaced year by year like it."""
    write_raw(column_rows(spark, columns), columns_path(raw_path), years=list(columns))


LEDGER_SCHEMA = f"{YEAR} int, path string, length bigint, sha256 string, n_rows bigint, {LOADED_AT} string, counts map<string,bigint>"


def ledger_path(raw_path: str) -> str:
    return raw_path.rstrip("/") + "_ledger"


def read_ledger(spark: SparkSession, raw_path: str, years: list[int] | None = None) -> DataFrame | None:
    """One row a loaded year, or None where no load has kept a ledger."""
    path = ledger_path(raw_path)
    return read_raw(spark, path, years) if Folders(spark, path).exists(path) else None


def loaded_years(spark: SparkSession, raw_path: str) -> set[int]:
    """The years that are loaded, by the ledger or else by the names of the raw
    table's folders; no data file is opened."""
    ledger = read_ledger(spark, raw_path)
    if ledger is not None:
        return {r[0] for r in ledger.select(YEAR).collect()}  # one row a year
    names = Folders(spark, raw_path).names(raw_path)
    return {int(n.split("=")[1]) for n in names if n.startswith(f"{YEAR}=")}


def columns_path(raw_path: str) -> str:
    return raw_path.rstrip("/") + "_columns"


def absent_columns(spark: SparkSession, raw_path: str, years: list[int]) -> list[tuple[int, str]]:
    """(year, column) that a requested year's file lacked; at most the
    allowlist's length a year."""
    table = read_raw(spark, columns_path(raw_path)).where(F.col(YEAR).isin(years) & ~F.col("present"))
    return [(r[YEAR], r["column_name"]) for r in table.select(YEAR, "column_name").collect()]


def rows_per_year(raw: DataFrame) -> DataFrame:
    """Per-year row counts of the raw layer (the load read-back)."""
    return raw.groupBy(YEAR).agg(F.count(F.lit(1)).alias("n_rows"))

