"""Declarative data-quality checks evaluated as single-pass Spark jobs.

Two families, as in the reference:

* **expectations** on the raw layer (row count in range, column exists, not
  NULL / in range / in set for at least a ``mostly`` fraction).  All checks of
  a suite become counters of *one* ``groupBy(year).agg(...)``: every year is
  validated in one pass, only one partial row per task and year is shuffled,
  and the long result (one row per year and check) is produced with
  ``explode`` of an array of structs -- no join, nothing collected.
* **data tests** on the models (not NULL, unique, accepted values, row
  expression true).  A test fails when it has failing rows; the row-level
  tests of one model are counted in one aggregate, ``unique`` by one grouped
  count of the key.  ``failing_rows`` returns the offending rows themselves
  (to be stored as tables).

``gate`` collects only the small result frame (checks x groups rows) and
raises when a check of severity ``error`` failed; ``warn`` checks are
reported but never stop a run.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratiform.sources.commit import Folders

ERROR = "error"
WARN = "warn"


@dataclass(frozen=True)
class Check:
    """One check.  ``kind`` is one of
    ``row_count_between, column_exists, not_null, between, in_set`` (expectations)
    or ``not_null, unique, accepted_values, expression`` (data tests)."""

    name: str
    kind: str
    column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    values: tuple = field(default_factory=tuple)
    mostly: float = 1.0
    expression: str | None = None
    severity: str = ERROR


class CheckFailed(RuntimeError):
    """Raised by ``gate`` when an error-severity check failed."""


def _c(name: str) -> Column:
    return F.col(name)


# ── expectations (mostly-fraction metrics) ──────────────────────────────────
ROWS = "rows"


def _counters(check: Check, present: set[str]) -> dict[str, tuple[str, Column]]:
    """What a check counts: its part (``d`` base, ``k`` kept) to a key that
    equal counters of other checks share, and the rows to count."""
    k, c = check.kind, check.column
    rows, known = (ROWS, F.lit(True)), (f"known({c})", F.isnotnull(_c(c)) if c else F.lit(True))
    if k == "row_count_between":
        return {"n": rows}
    if k == "column_exists" or (c is not None and c not in present):
        return {}
    if k == "not_null":
        return {"d": rows, "k": known}
    if k == "between":
        inside = _c(c).between(F.lit(check.min_value), F.lit(check.max_value))
        return {"d": known, "k": (f"between({c},{check.min_value!r},{check.max_value!r})", inside)}
    if k == "in_set":
        return {"d": known, "k": (f"in({c},{check.values!r})", _c(c).isin(list(check.values)))}
    raise ValueError(f"not an expectation kind: {k}")


def counters(checks: list[Check], present: set[str]) -> dict[str, Column]:
    """Every distinct counter of a suite; the number of rows is always one."""
    found = {ROWS: F.lit(True)}
    for check in checks:
        found |= dict(_counters(check, present).values())
    return found


def measure(df: DataFrame, checks: list[Check], by: list[str]) -> DataFrame:
    """(by, ``counts`` map of counter to rows) in one aggregate."""
    wanted = counters(checks, set(df.columns))
    found = df.groupBy(*by).agg(*[F.count_if(cond).alias(f"__c{i}") for i, cond in enumerate(wanted.values())])
    pairs = [x for i, key in enumerate(wanted) for x in (F.lit(key), F.col(f"__c{i}"))]
    return found.select(*by, F.create_map(*pairs).alias("counts"))


def _result_struct(check: Check, present: set[str], absent: Column | None) -> Column:
    """``absent``: the columns that a group's source lacked, if recorded."""
    k = check.kind
    count = {part: F.coalesce(F.element_at("counts", F.lit(key)), F.lit(0)) for part, (key, _) in _counters(check, present).items()}
    here = F.lit(check.column in present)
    if absent is not None and check.column in present:
        here = ~F.array_contains(absent, F.lit(check.column))
    if k == "row_count_between":
        n = count["n"].cast("double")
        observed = n
        passed = n.between(F.lit(check.min_value), F.lit(check.max_value))
        threshold = F.lit(f"[{check.min_value:g}, {check.max_value:g}]")
    elif k == "column_exists" or check.column not in present:
        observed = here.cast("double")
        passed = here if k == "column_exists" else F.lit(False)
        threshold = F.lit("present")
    else:
        d, kept = count["d"], count["k"]
        observed = F.when(here & (d > 0), kept.cast("double") / d.cast("double"))
        passed = here & F.coalesce(observed >= F.lit(check.mostly), F.lit(True))
        threshold = F.lit(f">= {check.mostly:g}")
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.kind).alias("kind"),
        F.lit(check.column).cast("string").alias("column_name"),
        observed.cast("double").alias("observed"),
        threshold.alias("threshold"),
        passed.alias("passed"),
        F.lit(check.severity).alias("severity"),
    )


def run_expectations(
    df: DataFrame,
    checks: list[Check],
    by: list[str] | None = None,
    groups: list[tuple] | None = None,
    absent: list[tuple] | None = None,
) -> DataFrame:
    """Evaluate a suite per group in one pass; one result row per group and check.

    Columns: ``*by, check_name, kind, column_name, observed, threshold,
    passed, severity``.  A missing column fails its ``column_exists`` check
    and its value checks.  ``groups`` are the requested groups (values of
    ``by``): each gets all its rows, one without data counts zero rows.
    ``absent`` are ``(*group, column)`` of columns that a group's source
    lacked although the unified table has them (filled with NULL).
    """
    by = by or []
    return judge(measure(df, checks, by), checks, set(df.columns), by, groups, absent)


def judge(
    metrics: DataFrame,
    checks: list[Check],
    present: set[str],
    by: list[str],
    groups: list[tuple] | None = None,
    absent: list[tuple] | None = None,
) -> DataFrame:
    """The results of a suite from counts that were taken before (``measure``,
    or counters observed while the rows were written): no row is read here."""
    spark = metrics.sparkSession
    keys = [metrics.schema[c] for c in by]
    if groups is not None:
        wanted = spark.createDataFrame(groups, StructType(keys))
        none = F.create_map(F.lit(ROWS), F.lit(0).cast("bigint"))
        metrics = wanted.join(metrics, on=by, how="left").withColumn("counts", F.coalesce("counts", none))
    lacking = None
    if absent:
        table = spark.createDataFrame(absent, StructType([*keys, StructField("__column", StringType())]))
        table = table.groupBy(*by).agg(F.collect_set("__column").alias("__absent"))  # at most a suite's columns a group
        metrics = metrics.join(table, on=by, how="left")
        lacking = F.coalesce(F.col("__absent"), F.array().cast("array<string>"))
    structs = [_result_struct(ch, present, lacking) for ch in checks]
    return metrics.select(*by, F.inline(F.array(*structs)))


# ── data tests (failing rows) ───────────────────────────────────────────────
def failure_condition(check: Check) -> Column:
    """Row-level condition of a failing row (``unique`` is not row-level)."""
    k, c = check.kind, check.column
    if k == "not_null":
        return _c(c).isNull()
    if k == "accepted_values":
        return _c(c).isNotNull() & ~_c(c).isin(list(check.values))
    if k == "expression":
        # A row whose expression is NULL passes: only a definite false fails.
        return F.coalesce(~F.expr(check.expression), F.lit(False))
    raise ValueError(f"not a row-level test: {k}")


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows that make a data test fail (for ``unique``: duplicated keys)."""
    if check.kind == "unique":
        c = check.column
        return (
            df.where(_c(c).isNotNull())
            .groupBy(c)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1)
        )
    return df.where(failure_condition(check))


def run_data_tests(df: DataFrame, checks: list[Check] | dict[str, list[Check]], model: str = "model") -> DataFrame:
    """Failure counts of data tests: ``model, test_name, kind, column_name,
    n_failures, passed, severity``.

    ``checks`` may map several model names to their tests when those models
    are projections of the same rows (e.g. staging and the row-local flag and
    risk models over the enriched frame): all row-level tests then share one
    aggregate, and each distinct ``unique`` key is counted by one shuffle.
    """
    suites = checks if isinstance(checks, dict) else {model: checks}
    row_level = [(m, c) for m, cs in suites.items() for c in cs if c.kind != "unique"]
    parts: list[DataFrame] = []
    if row_level:
        counts = df.agg(*[F.count_if(failure_condition(c)).alias(f"f{i}") for i, (_, c) in enumerate(row_level)])
        structs = [
            F.struct(
                F.lit(m).alias("model"),
                F.lit(c.name).alias("test_name"),
                F.lit(c.kind).alias("kind"),
                F.lit(c.column).cast("string").alias("column_name"),
                F.col(f"f{i}").alias("n_failures"),
                F.lit(c.severity).alias("severity"),
            )
            for i, (m, c) in enumerate(row_level)
        ]
        parts.append(counts.select(F.inline(F.array(*structs))))
    unique = [(m, c) for m, cs in suites.items() for c in cs if c.kind == "unique"]
    for column in dict.fromkeys(c.column for _, c in unique):
        dup = failing_rows(df, Check("unique", "unique", column=column)).agg(F.count(F.lit(1)).alias("n"))
        structs = [
            F.struct(
                F.lit(m).alias("model"),
                F.lit(c.name).alias("test_name"),
                F.lit(c.kind).alias("kind"),
                F.lit(c.column).cast("string").alias("column_name"),
                F.col("n").alias("n_failures"),
                F.lit(c.severity).alias("severity"),
            )
            for m, c in unique
            if c.column == column
        ]
        parts.append(dup.select(F.inline(F.array(*structs))))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(
        "model",
        "test_name",
        "kind",
        "column_name",
        F.col("n_failures").cast("bigint").alias("n_failures"),
        (F.col("n_failures") == 0).alias("passed"),
        "severity",
    )


def store_failures(df: DataFrame, checks: list[Check], root: str, model: str) -> dict[str, str]:
    """Write the failing rows of every test to ``root/<model>/<test>`` (Parquet)."""
    paths = {}
    for c in checks:
        path = f"{root.rstrip('/')}/{model}/{c.name}"
        failing_rows(df, c).write.mode("overwrite").parquet(path)
        paths[c.name] = path
    return paths


def store_all_failures(df: DataFrame, suites: dict[str, list[Check]], root: str) -> None:
    """Write the failing rows of every given test to ``root/<model>/<test>``.

    Row-level tests share one scan, however many fail: each row gets the list
    of tests it fails, and is written once for each, into that test's folder.
    Repeated keys are rows of another shape: one grouped write a key column.
    """
    rows = [(m, c) for m, cs in suites.items() for c in cs if c.kind != "unique"]
    if rows:
        marks = [F.when(failure_condition(c), F.struct(F.lit(m).alias("__model"), F.lit(c.name).alias("__test"))) for m, c in rows]
        failed = df.withColumn("__failed", F.filter(F.array(*marks), lambda x: x.isNotNull())).where(F.size("__failed") > 0)
        each = failed.select(*df.columns, F.inline("__failed"))
        folder = f"{root.rstrip('/')}/_all"
        each.write.mode("overwrite").partitionBy("__model", "__test").parquet(folder)
        folders = Folders(df.sparkSession, folder)
        for m, c in rows:
            written = f"{folder}/__model={m}/__test={c.name}"
            if folders.exists(written):
                folders.delete(f"{root.rstrip('/')}/{m}/{c.name}")
                folders.move(written, f"{root.rstrip('/')}/{m}/{c.name}")
        folders.delete(folder)
    for m, cs in suites.items():
        store_failures(df, [c for c in cs if c.kind == "unique"], root, m)


def gate(results: DataFrame, label: str = "checks") -> list[dict]:
    """Raise ``CheckFailed`` if any error-severity check failed.

    ``results`` is a (small) result frame from ``run_expectations`` or
    ``run_data_tests``; all checks are evaluated before the decision.
    Returns the failed rows (also warnings) as dicts.
    """
    failed = [r.asDict() for r in results.where(~F.col("passed")).collect()]
    errors = [r for r in failed if r.get("severity", ERROR) == ERROR]
    if errors:
        names = sorted({str(r.get("check_name") or r.get("test_name")) for r in errors})
        raise CheckFailed(f"{label}: {len(errors)} failed check(s): {', '.join(names)}")
    return failed
