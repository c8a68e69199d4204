"""Deterministic dense row numbers without a single-partition window.

``row_number() over (order by k)`` makes Spark move every row into one task.
``dense_row_id`` computes the same numbering distributed:

1. range-partition on the order columns and sort within partitions (one
   shuffle; the range partitioner splits the key space evenly from a sample);
2. tag each row with ``monotonically_increasing_id`` (partition index in the
   upper bits, in-partition ordinal in the lower 33 bits) and checkpoint to
   the shared folder, so both following passes see the same rows in the same
   partitions;
3. count rows per partition -- one row per partition, collected (bounded by
   the partition count, not by the data);
4. number = offset of the partition + in-partition ordinal + 1, looked up in
   the broadcast table of offsets.

``order_cols`` must be a total order (unique) for the result to be
deterministic; ties are broken by the input order of the range shuffle.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.session import reliable_checkpoint

_ORDINAL_BITS = 33
_TAG = "__sf_mono"
_TIE = "__sf_tie"


def _partition_count(df: DataFrame, num_partitions: int | None) -> int:
    """Explicit count, else the session's shuffle partitions (which the user
    sizes with the data); the input's plan is not probed."""
    return num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def ranged_with_ordinals(
    df: DataFrame, order_cols: list[str | Column], num_partitions: int | None = None
) -> tuple[DataFrame, list[int]]:
    """Range-partitioned, sorted, checkpointed frame + per-partition start offsets.

    The returned frame has a hidden ``__sf_mono`` column; ``with_global_ordinal``
    turns it into a 0-based global position.
    """
    n = _partition_count(df, num_partitions)
    ranged = (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn(_TAG, F.monotonically_increasing_id())
    )
    ranged = reliable_checkpoint(ranged)
    pid = F.shiftright(F.col(_TAG), _ORDINAL_BITS)
    rows = ranged.groupBy(pid.alias("pid")).agg(F.count(F.lit(1)).alias("n")).collect()
    per_part = [0] * (max((r["pid"] for r in rows), default=-1) + 1)
    for r in rows:
        per_part[r["pid"]] = r["n"]
    offsets = [0, *accumulate(per_part)]
    return ranged, offsets


def with_global_ordinal(ranged: DataFrame, offsets: list[int], out_col: str) -> DataFrame:
    """Add the 0-based global position as ``out_col``: a join to the table of
    (partition id, offset), broadcast -- its size is the partition count, not
    the data size."""
    spark = ranged.sparkSession
    table = spark.createDataFrame([(i, o) for i, o in enumerate(offsets[:-1])], "__sf_pid int, __sf_off bigint")
    tag = F.col(_TAG)
    joined = ranged.withColumn("__sf_pid", F.shiftright(tag, _ORDINAL_BITS).cast("int")).join(
        F.broadcast(table), on="__sf_pid", how="inner"
    )
    pos = F.col("__sf_off") + tag.bitwiseAND(F.lit((1 << _ORDINAL_BITS) - 1))
    return joined.withColumn(out_col, pos).drop("__sf_pid", "__sf_off")


def dense_row_id(
    df: DataFrame,
    order_cols: list[str | Column],
    id_col: str = "row_id",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``id_col`` = 1..N in ``order_cols`` order, computed on all executors.

    A row tag is appended as the last sort key, so rows sharing one order
    value (even a third of the table) still spread over many range
    partitions; ties are numbered in input order.
    """
    tagged = df.withColumn(_TIE, F.monotonically_increasing_id())
    ranged, offsets = ranged_with_ordinals(tagged, [*order_cols, _TIE], num_partitions)
    out = with_global_ordinal(ranged, offsets, id_col)
    return out.withColumn(id_col, F.col(id_col) + F.lit(1)).drop(_TAG, _TIE)
