"""Weighted survey estimators as aggregate ``Column`` builders.

Every builder is a plain Catalyst expression: Spark computes them with a
partial (map-side) aggregate per task and a final aggregate after one small
shuffle, so a grouped estimate over billions of rows ships only one partial
row per group and task.  Identical sub-aggregates (the ``sum(weight)`` shared
by every proportion of a query) are computed once by the optimizer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratiform.schema import WEIGHT


def _all_text(*args) -> bool:
    return all(isinstance(a, str) for a in args)


def _cond(c: Column | str) -> Column:
    """A condition given as a Column or as SQL text."""
    return F.expr(c) if isinstance(c, str) else c


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / nullif(denominator, 0)``: NULL instead of a division error."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def weighted_count(condition: Column | str, weight: Column | str = WEIGHT) -> Column:
    """Population-weighted count: ``sum(case when cond then w else 0 end)``.

    A NULL condition counts as not met.
    """
    if _all_text(condition, weight):
        return F.expr(weighted_count_sql(condition, weight))
    w = _col(weight)
    return F.sum(F.when(_cond(condition), w).otherwise(F.lit(0.0)))


def weighted_count_sql(condition: str, weight: str = WEIGHT) -> str:
    return f"sum(CASE WHEN {condition} THEN {weight} ELSE 0D END)"


def weighted_proportion_sql(condition: str, weight: str = WEIGHT) -> str:
    return f"{weighted_count_sql(condition, weight)} / nullif(sum({weight}), 0D)"


def weighted_total(weight: Column | str = WEIGHT) -> Column:
    """Population estimate of a domain: ``sum(w)``."""
    return F.sum(_col(weight))


def weighted_proportion(condition: Column | str, weight: Column | str = WEIGHT) -> Column:
    """Horvitz-Thompson proportion ``sum(w * [cond]) / nullif(sum(w), 0)``.

    The denominator is every weight in the group, including rows whose outcome
    is NULL: unknown outcomes count as "no".  NULL when the weights sum to 0.
    """
    if _all_text(condition, weight):
        return F.expr(weighted_proportion_sql(condition, weight))
    return safe_ratio(weighted_count(condition, weight), weighted_total(weight))


def weighted_mean(value: Column | str, weight: Column | str = WEIGHT) -> Column:
    """Weighted mean of a numeric with a NULL-aware denominator.

    ``sum(x * w) / nullif(sum(case when x is not null then w end), 0)``.
    """
    if _all_text(value, weight):
        return F.expr(f"sum({value} * {weight}) / nullif(sum(CASE WHEN {value} IS NOT NULL THEN {weight} END), 0D)")
    x, w = _col(value), _col(weight)
    return safe_ratio(F.sum(x * w), F.sum(F.when(x.isNotNull(), w)))


def unweighted_proportion(condition: Column | str) -> Column:
    """Share of rows meeting the condition, ignoring weights (biased baseline)."""
    return F.avg(F.when(_cond(condition), F.lit(1.0)).otherwise(F.lit(0.0)))


def count_rows() -> Column:
    """``count(*)`` as BIGINT."""
    return F.count(F.lit(1))


def conditional_count(condition: Column | str) -> Column:
    """Unweighted count of rows meeting the condition (NULL counts as not met)."""
    if isinstance(condition, str):
        return F.expr(f"count(CASE WHEN {condition} THEN 1 END)")
    return F.count(F.when(_cond(condition), F.lit(1)))


def suppress(estimate: Column | str, n: Column | str, min_cell: int = 50) -> Column:
    """Small-cell suppression: the estimate when ``n >= min_cell``, else NULL.

    This masks a value; it never removes the row.
    """
    if _all_text(estimate, n):
        return F.expr(f"CASE WHEN {n} >= {int(min_cell)} THEN {estimate} END")
    return F.when(_col(n) >= F.lit(min_cell), _col(estimate))


def percent(x: Column | str, digits: int = 1) -> Column:
    """Proportion -> percent rounded for reports."""
    return F.round(_col(x) * F.lit(100.0), digits)


def millions(x: Column | str, digits: int = 1) -> Column:
    """Total -> millions rounded for reports."""
    return F.round(_col(x) / F.lit(1e6), digits)
