"""Sharding (operator 3): runs of a Hilbert curve over metadata dimensions.

Each dimension is quantised to a few bits (categories by hash, sizes by their
logarithm); the cell's index on a Hilbert curve orders the rows, and runs of
equal row counts become shards.  Neighbours on the curve are neighbours in
every dimension, so the per-shard ranges of ``shard_bounds`` prune files for
filters on any of them.

The global position comes from ``dense_row_id``: a range shuffle of five narrow
columns, one count per partition, no single-task sort; a cell that holds a
third of the rows is split, because the tie breakers are sort keys too.

Defined cases: null text has size 1 and checksum 0; null categories are a
category; a null id sorts first; equal rows keep separate slots; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import table
from stratiform.operators.keys import dense_row_id


def curve_index(axes: list[np.ndarray], bits: int) -> np.ndarray:
    """Hilbert index of integer points (Skilling's transform, vectorised)."""
    x = [np.asarray(a, np.int64).copy() for a in axes]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(n):
            upper = (x[i] & bit) != 0
            swap = np.where(upper, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(upper, x[0] ^ below, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[n - 1] & (1 << level)) != 0, turn ^ ((1 << level) - 1), turn)
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << 1) | (((axis ^ turn) >> level) & 1)
    return index


def category(column: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(column.cast("string"), F.lit("\u0000"))), F.lit(1 << bits)).cast("long")


def magnitude(column: Column, bits: int, per_doubling: int = 2) -> Column:
    """Steps of a logarithmic scale, the top one open."""
    steps = F.floor(F.log2(F.greatest(column.cast("double"), F.lit(1.0))) * per_doubling)
    return F.least(steps.cast("long"), F.lit((1 << bits) - 1))


def hilbert_order(rows: DataFrame, dimensions: list[Column], bits: int, out_col: str = "curve") -> DataFrame:
    @F.pandas_udf("long")
    def index(*axes: pd.Series) -> pd.Series:
        return pd.Series(curve_index([a.to_numpy() for a in axes], bits))

    return rows.withColumn(out_col, index(*dimensions))


def cut_runs(rows: DataFrame, order: list[str], n_rows: int, n_shards: int) -> DataFrame:
    """``shard`` and ``slot``: runs along ``order``, counts at most one apart."""
    if not n_rows:
        return rows.where(F.lit(False)).select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranked = dense_row_id(rows, order, "__rank").withColumn("__rank", F.col("__rank") - 1)
    shard = F.expr(f"(__rank * {n_shards}) div {n_rows}")
    first = F.expr(f"(shard * {n_rows}L + {n_shards - 1}) div {n_shards}")
    return ranked.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("__rank") - first).drop("__rank")


def shard_bounds(sharded: DataFrame, dimensions: list[str]) -> DataFrame:
    """Per shard the least and greatest value of each dimension."""
    each = [f(c).alias(f"{n}_{c}") for c in dimensions for n, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), *each)


def hilbert_shards(docs: DataFrame, n_shards: int = 8, bits: int = 5) -> DataFrame:
    """One narrow row per document: its checksum, curve cell, shard and slot."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
    )
    dimensions = [category(F.col("lang"), bits), category(F.col("source"), bits), magnitude(F.col("size"), bits)]
    placed = hilbert_order(rows, dimensions, bits)
    return cut_runs(placed, ["curve", "doc_id", "text_crc32", "size"], docs.count(), n_shards)


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )
