"""Join helpers.  Whether a side is broadcast is left to Spark's statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def lookup_join(df: DataFrame, lookup: DataFrame, on: Column | str | list[str], how: str = "left") -> DataFrame:
    """Left equi-join to a dimension; unmatched rows keep NULL attributes.

    No hint: a small file or local table is broadcast by its known size, an
    aggregate by the size that adaptive execution measures, and anything
    larger is shuffled, with skewed partitions split.
    """
    return df.join(lookup, on=on, how=how)


def null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match, as in grouping; ``right`` gives its
    other columns only."""
    renamed = right.withColumnsRenamed({c: f"__right_{c}" for c in on})
    condition = None
    for c in on:
        same = left[c].eqNullSafe(renamed[f"__right_{c}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"__right_{c}" for c in on])
