"""Landing manifest: which yearly files are present, their size and SHA-256.

Listing and year selection never read contents.  The manifest opens only the
files it is asked for; each is hashed in chunks by the task that has its
path, so a file of any size takes the same way.  Year selection skips years
whose raw partition exists unless forced, and refuses files below the
minimum size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Minimum plausible size of a yearly file and its name pattern.
MIN_FILE_BYTES = 10_000_000
YEAR_FILE_PATTERN = r"(?i)llcp(\d{4})\.xpt$"
_CHUNK = 8 << 20


def _stream_sha256(batches):
    """mapInPandas: (path, length) -> (path, length, sha256) reading 8 MB chunks."""
    import hashlib

    import pandas as pd

    from stratiform.sources.xpt import _resolve

    for pdf in batches:
        digests = []
        for path in pdf["path"]:
            fs, p = _resolve(path)
            h = hashlib.sha256()
            with fs.open_input_stream(p) as fh:
                while chunk := fh.read(_CHUNK):
                    h.update(chunk)
            digests.append(h.hexdigest())
        yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"], "sha256": digests})


def file_path(year: int, landing_dir: str) -> str:
    return f"{landing_dir.rstrip('/')}/LLCP{year}.XPT"


def _describe_files(df: DataFrame, min_bytes: int, name_pattern: str, with_hash: bool) -> DataFrame:
    name = F.regexp_extract(F.col("path"), r"([^/]+)$", 1)
    extra = [F.col("sha256")] if with_hash else []
    return df.select(
        "path",
        name.alias("file_name"),
        F.regexp_extract(name, name_pattern, 1).alias("_y"),
        F.col("length"),
        *extra,
    ).select(
        "path",
        "file_name",
        F.when(F.col("_y") != "", F.col("_y").cast("int")).alias("year"),
        "length",
        *(["sha256"] if with_hash else []),
        (F.col("length") >= F.lit(min_bytes)).alias("large_enough"),
        F.col("file_name").rlike(r"(?i)\.xpt$").alias("is_year_file"),
    )


def listing(
    spark: SparkSession,
    landing_dir: str,
    glob: str = "*",
    min_bytes: int = MIN_FILE_BYTES,
    name_pattern: str = YEAR_FILE_PATTERN,
) -> DataFrame:
    """The manifest without hashes: file contents are never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(landing_dir)
    return _describe_files(files.select("path", "length"), min_bytes, name_pattern, with_hash=False)


def manifest(
    spark: SparkSession,
    landing_dir: str,
    glob: str = "*",
    min_bytes: int = MIN_FILE_BYTES,
    name_pattern: str = YEAR_FILE_PATTERN,
    paths: list[str] | None = None,
) -> DataFrame:
    """``path, file_name, year, length, sha256, large_enough, is_year_file`` of
    the folder's files, or of ``paths`` only."""
    reader = spark.read.format("binaryFile")
    files = reader.load(paths) if paths else reader.option("pathGlobFilter", glob).load(landing_dir)
    # The listing alone would put many files into one task.
    files = one_task_each(files.select("path", "length"), "path")
    hashed = files.mapInPandas(_stream_sha256, "path string, length bigint, sha256 string")
    return _describe_files(hashed, min_bytes, name_pattern, with_hash=True)


def one_task_each(rows: DataFrame, column: str) -> DataFrame:
    """Rows dealt out by rank of a distinct value: one task for each.  Hashing
    the value instead would put several into one task by chance."""
    names = sorted(r[0] for r in rows.select(column).collect())  # one a yearly file
    if len(names) < 2:
        return rows.coalesce(1)
    bounds = F.array(*[F.lit(n) for n in names])
    return rows.repartitionByRange(len(names), F.array_position(bounds, F.col(column)))


def files_to_load(
    spark: SparkSession,
    landing: DataFrame,
    years: list[int],
    loaded: DataFrame | set[int] | None = None,
    force: bool = False,
) -> dict[int, str]:
    """Year to path, as listed, of the requested years that are not loaded yet.

    ``loaded`` are the loaded years (``ingest.loaded_years``), or a frame that
    has them in ``survey_year``.  One row per requested landed file is collected.  Raises
    ``FileNotFoundError`` for a requested year without a file, ``ValueError``
    for one below the minimum size or with several files.
    """
    rows = landing.where(F.col("is_year_file") & F.col("year").isin(list(years))).collect()
    missing = sorted(set(years) - {r["year"] for r in rows})
    if missing:
        raise FileNotFoundError(f"no landed file for year(s) {missing}")
    done: set[int] = set()
    if loaded is not None and not force:
        done = {r[0] for r in loaded.select("survey_year").distinct().collect()} if isinstance(loaded, DataFrame) else set(loaded)
    found: dict[int, str] = {}
    for r in sorted(rows, key=lambda r: r["path"]):
        if r["year"] in done:
            continue
        if not r["large_enough"]:
            raise ValueError(f"{r['path']}: {r['length']} bytes, below the minimum size")
        if r["year"] in found:
            raise ValueError(f"two files for {r['year']}: {found[r['year']]}, {r['path']}")
        found[r["year"]] = r["path"]
    return found


def years_to_load(
    spark: SparkSession,
    landing: DataFrame,
    years: list[int],
    loaded: DataFrame | set[int] | None = None,
    force: bool = False,
) -> list[int]:
    """The years of ``files_to_load``."""
    return sorted(files_to_load(spark, landing, years, loaded, force))
