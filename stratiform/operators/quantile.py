"""Exact continuous percentiles and weight winsorizing by selection.

Spark's exact ``percentile`` buffers every value of a group in one task, and a
full sort moves the whole column to find two values.  Here all positions that
are asked for, of all percentiles and groups, are found together:

1. one sketch pass (a partial aggregate of bounded size) cuts each group's
   values at points around every position;
2. one counting pass counts the rows in each cell between the points, with the
   least and greatest value of each: a cell is one row, whatever it holds.  The
   cells next to a position, if few rows are expected in them, are counted value
   by value in the same pass.

The counts say in which cell a position lies and *prove* it: exact running sums,
not the sketch, decide.  A cell with one distinct value gives its value.  A cell
with several is cut again (steps 1 and 2 over its rows only), so a bad sketch or
many values in a cell cost another round, never a wrong value; a cell whose
least and greatest value cannot be parted any more has one value each.  For
global percentiles the driver holds some cells of each; grouped percentiles stay
on Spark.  NULL is a group like any other; NULL and NaN values have no position.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratiform.operators.joins import null_safe
from stratiform.schema import WEIGHT

ACCURACY = 100_000  # sketch size; the first cells span six of its rank errors
SMALL = 2_000  # distinct values that a cell may have to be counted one by one
CUTS = 64  # cells that a cell is parted into
_LARGEST = sys.float_info.max


def _check(ps: list[float]) -> None:
    for p in ps:
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"percentile must be in [0, 1], got {p}")


def _values(df: DataFrame, by: list[str], column: str) -> DataFrame:
    values = df.select(*by, F.col(column).cast("double").alias("__v"))
    return values.where(F.col("__v").isNotNull() & ~F.isnan("__v"))


def _sketched(values: DataFrame, by: list[str], ps: list[float]) -> DataFrame:
    """(by, ``__cuts``): sorted distinct values around each position."""
    margin = 3.0 / ACCURACY
    at = sorted({min(1.0, max(0.0, p + d)) for p in ps for d in (-margin, margin)})
    cuts = F.percentile_approx("__v", at, ACCURACY)
    return values.groupBy(*by).agg(F.array_sort(F.array_distinct(cuts)).alias("__cuts"))


def _cell(cuts: Column, v: Column) -> Column:
    """2 i + 1 at cut i, 2 i between cut i - 1 and cut i: a tie of many rows has
    a cell of its own."""
    below = F.size(F.filter(cuts, lambda c: c < v))
    return 2 * below + F.array_contains(cuts, v).cast("int")


def _cells(values: DataFrame, cuts: DataFrame, by: list[str]) -> DataFrame:
    """(by, lo, hi, c) of every cell that has rows."""
    placed = null_safe(values, cuts, by).groupBy(*by, _cell(F.col("__cuts"), F.col("__v")).alias("__cell"))
    return placed.agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.count(F.lit(1)).alias("__c"))


def _positions(p: float, n: int) -> tuple[int, int, float]:
    at = p * (n - 1)
    return math.floor(at), math.ceil(at), at


def _between(lo: float, hi: float, low: int, high: int, at: float) -> float:
    return lo if low == high else (high - at) * lo + (at - low) * hi


def percentile_cont(df: DataFrame, column: str, p: float) -> float | None:
    """``percentile_cont(p) within group (order by column)`` over all non-NULL rows.

    Linear interpolation between the values at positions floor/ceil of
    ``p * (n - 1)``; NULL (None) for an empty input.
    """
    return percentiles_cont(df, column, [p])[0]


def percentiles_cont(df: DataFrame, column: str, ps: list[float]) -> list[float | None]:
    """Several exact percentiles: two scans for any number of them, and two more
    over the rows of unsettled cells only where those hold many values."""
    _check(ps)
    values = _values(df, [], column)
    margin = 3.0 / ACCURACY
    spans = [(max(0.0, p - margin), min(1.0, p + margin)) for p in ps]
    ends = F.percentile_approx("__v", [x for span in spans for x in span], ACCURACY)
    sketch = values.agg(ends.alias("cuts"), F.count(F.lit(1)).alias("n")).first()
    if not sketch["n"]:
        return [None] * len(ps)
    cuts, n = sketch["cuts"], sketch["n"]
    near = list(zip(cuts[::2], cuts[1::2])) if 2 * margin * n * len(ps) <= SMALL else []
    cells = _count_cells(values, sorted(set(cuts)), near)
    wanted = {i for p in ps for i in _positions(p, n)[:2]}
    known = _settle(values, cells, wanted)
    return [_between(known[low], known[high], low, high, at) for low, high, at in (_positions(p, n) for p in ps)]


def _count_cells(values: DataFrame, cuts: list[float], near: list[tuple[float, float]] = ()) -> list[tuple[float, float, int]]:
    """(least, greatest, rows) of each cell in order; values inside the ranges
    ``near`` are cells of their own, unless they turn out to be many."""
    cell = _cell(F.array(*[F.lit(float(c)) for c in cuts]), F.col("__v")).alias("cell")
    own = F.when(_any([F.col("__v").between(F.lit(a), F.lit(b)) for a, b in near]), F.col("__v")) if near else F.lit(None)
    counted = values.groupBy(cell, own.alias("own")).agg(F.min("__v").alias("lo"), F.max("__v").alias("hi"), F.count(F.lit(1)).alias("c"))
    most = 2 * len(cuts) + 1 + 4 * SMALL
    rows = counted.limit(most + 1).collect()
    if len(rows) > most:  # a bad sketch: the ranges hold more than they should
        return _count_cells(values, cuts)
    return sorted((r["lo"], r["hi"], r["c"]) for r in rows)


def _settle(values: DataFrame, cells: list[tuple[float, float, int]], wanted: set[int]) -> dict[int, float]:
    """The values at the wanted positions, cutting the cells that hold them."""
    while True:
        known: dict[int, float] = {}
        loose, start = [], 0
        for lo, hi, c in cells:
            inside = [i for i in wanted if start <= i < start + c]
            for i in inside:
                if lo == hi or i == start:
                    known[i] = lo
                elif i == start + c - 1:
                    known[i] = hi
            if any(i not in known for i in inside):
                loose.append((lo, hi))
            start += c
        if not loose:
            return known
        some = values.where(_any([F.col("__v").between(F.lit(lo), F.lit(hi)) for lo, hi in loose]))
        cuts = {x for lo, hi in loose for x in _parted(some, lo, hi, sum(c for a, b, c in cells if (a, b) == (lo, hi)))}
        finer = _count_cells(some, sorted(cuts | {x for cell in loose for x in cell}))
        cells = sorted([x for x in cells if (x[0], x[1]) not in loose] + finer)


def _any(tests: list[Column]) -> Column:
    found = tests[0]
    for t in tests[1:]:
        found = found | t
    return found


def _parted(values: DataFrame, lo: float, hi: float, rows: int) -> list[float]:
    """Values that part the cell: all of them if it has few rows, else quantiles
    of its rows, and the middle of its range in case the sketch is bad."""
    inside = values.where(F.col("__v").between(F.lit(lo), F.lit(hi)))
    if rows <= SMALL:
        return [r[0] for r in inside.select("__v").distinct().collect()]  # at most SMALL
    share = [i / CUTS for i in range(1, CUTS)]
    middle = max(lo, -_LARGEST) / 2 + min(hi, _LARGEST) / 2
    return [*(inside.agg(F.percentile_approx("__v", share, ACCURACY)).first()[0] or []), middle]


def percentile_cont_by(df: DataFrame, by: list[str], column: str, p: float, out_col: str = "percentile") -> DataFrame:
    """Exact ``percentile_cont(p)`` of ``column`` per group, as a lazy DataFrame."""
    return percentiles_cont_by(df, by, column, {out_col: p})


def percentiles_cont_by(df: DataFrame, by: list[str], column: str, wanted: dict[str, float]) -> DataFrame:
    """Several exact percentiles per group: one sketch and one counting pass.

    A position's cell is known exactly from the counts.  Rows of the cells that
    hold a position and more than one value are then counted by value, so a bad
    sketch costs work and no exactness.
    """
    _check(list(wanted.values()))
    values = _values(df, by, column)
    cuts = _sketched(values, by, list(wanted.values()))
    cells = _cells(values, cuts, by)
    order = Window.partitionBy(*by).orderBy("__cell")  # some cells a group
    cells = cells.withColumn("__end", F.sum("__c").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    cells = cells.withColumn("__n", F.sum("__c").over(Window.partitionBy(*by))).withColumn("__start", F.col("__end") - F.col("__c"))
    ends = [f(F.lit(p) * (F.col("__n") - 1)) for p in wanted.values() for f in (F.floor, F.ceil)]
    held = _any([(F.col("__start") <= i) & (i < F.col("__end")) for i in ends])
    cells = cells.where(held).select(*by, "__lo", "__hi", "__c", "__start", "__n")
    loose = cells.where("__lo < __hi").select(*by, F.col("__lo").alias("__a"), F.col("__hi").alias("__b"), F.col("__start").alias("__base"), "__n")
    inside = null_safe(values, loose, by).where("__v BETWEEN __a AND __b")
    fine = inside.groupBy(*by, "__base", "__n", "__v").agg(F.count(F.lit(1)).alias("__c"))
    running = Window.partitionBy(*by, "__base").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    fine = fine.withColumn("__start", F.col("__base") + F.sum("__c").over(running) - F.col("__c"))
    each = cells.where("__lo = __hi").select(*by, F.col("__lo").alias("__v"), "__start", "__c", "__n")
    each = each.unionByName(fine.select(*by, "__v", "__start", "__c", "__n"))
    at = lambda i: F.max(F.when((F.col("__start") <= i) & (i < F.col("__start") + F.col("__c")), F.col("__v")))
    found = each.groupBy(*by).agg(F.first("__n").alias("__n"), *[at(i).alias(f"__e{k}") for k, i in enumerate(ends)])
    out = []
    for k, (name, p) in enumerate(wanted.items()):
        pos = F.lit(p) * (F.col("__n") - 1)
        lo, hi = F.col(f"__e{2 * k}"), F.col(f"__e{2 * k + 1}")
        low, high = F.floor(pos), F.ceil(pos)
        out.append(F.when(low == high, lo).otherwise((high - pos) * lo + (pos - low) * hi).alias(name))
    return found.select(*by, *out)


def winsorize(
    df: DataFrame,
    weight_col: str = WEIGHT,
    upper_percentile: float = 0.99,
    out_col: str | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Cap a weight at its global ``upper_percentile`` (trim only, no rescale).

    ``least`` skips NULL, so a NULL weight becomes the cap, as in the
    reference semantics.  Globally the cap is one scalar, applied as a
    literal in a narrow projection: no join, no shuffle of the input.  With
    ``by`` each group is capped at its own percentile (one cap row per group,
    joined back with NULL keys matching).
    """
    target = out_col or weight_col
    if by:
        caps = percentile_cont_by(df, by, weight_col, upper_percentile, out_col="__cap")
        joined = null_safe(df, caps, by, "left")
        return joined.withColumn(target, F.least(F.col(weight_col), F.col("__cap"))).drop("__cap")
    cap = percentile_cont(df, weight_col, upper_percentile)
    if cap is None:
        return df.withColumn(target, F.col(weight_col))
    return df.withColumn(target, F.least(F.col(weight_col), F.lit(cap)))
