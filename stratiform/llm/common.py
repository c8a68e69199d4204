"""Shared helpers of the training-data operators.

Everything here runs inside Spark tasks on Arrow batches or is a small frame
helper.  The rolling hash works on a whole byte buffer at once: every byte is
mapped to a random 64-bit word, multiplied by a power of an odd base and
prefix-summed, so that the hash of any byte range is one subtraction and one
multiplication (mod 2**64), followed by a bit mixer.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.session import checkpoint_dir, reliable_checkpoint

#: Bytes of text that one vectorised step looks at; bounds a task's memory.
CHUNK_BYTES = 1 << 19

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_BYTE_WORDS = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * _U64(2) + _U64(1)
_powers: list[np.ndarray] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder; later reads start there."""
    checkpoint_dir(df.sparkSession)
    return reliable_checkpoint(df)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on; all others stay out of its way."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and row offsets of a string column; null is empty."""
    column = pa.array(column.to_pylist(), pa.large_binary()) if not isinstance(column, pa.Array) else column
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n, start = len(column), column.offset
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, n + 1 + start)[start:] if n else np.zeros(1, np.int64)
    if not n or buffers[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def row_groups(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes (a longer row alone)."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


_held: list = []


def held(cached):
    """Registers a cached function whose value a worker keeps from task to task."""
    _held.append(cached)
    return cached


def release(keep=None) -> None:
    """Give freed memory back to the system.  A Python worker is reused, and
    would otherwise hold the peak of every earlier task and what the tasks of
    other operators keep (``held``); ``keep`` is the caller's own."""
    for cached in _held:
        if cached is not keep:
            cached.cache_clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n + 1:
        size = max(n + 1, CHUNK_BYTES + 4096)
        steps = np.full(size, _U64(_BASE)), np.full(size, _U64(_INV))
        for s in steps:
            s[0] = 1
        _powers[:] = [np.multiply.accumulate(s) for s in steps]
    return _powers[0], _powers[1]


class RangeHash:
    """Hashes of byte ranges of one buffer."""

    def __init__(self, data: np.ndarray) -> None:
        power, self.inverse = _power_tables(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_WORDS[data] * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def fixed(self, width: int) -> np.ndarray:
        """Hashes of all ranges of ``width`` bytes, by start."""
        n = max(0, len(self.sums) - width)
        return mix((self.sums[width:] - self.sums[:n]) * self.inverse[:n] + _U64(width))


def pack(*arrays: np.ndarray) -> bytes:
    """Non-negative integer columns as one compressed value: each in the
    narrowest type that holds it, byte planes apart."""
    head, body = [len(arrays)], []
    for a in arrays:
        a = np.asarray(a)
        a = a.astype(np.min_scalar_type(int(a.max())) if len(a) else np.uint8)
        head += [len(a), a.itemsize]
        body.append(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes())
    return np.array(head, "<i8").tobytes() + zstandard.ZstdCompressor(level=1).compress(b"".join(body))


def unpack(blob: bytes) -> list[np.ndarray]:
    """Columns of ``pack`` as unsigned 64-bit numbers."""
    n = int(np.frombuffer(blob, "<i8", 1)[0])
    head = np.frombuffer(blob, "<i8", 2 * n, 8).tolist()
    body = zstandard.ZstdDecompressor().decompress(blob[8 + 16 * n :], max_output_size=max(1, sum(a * b for a, b in zip(head[::2], head[1::2]))))
    out, at = [], 0
    for size, width in zip(head[::2], head[1::2]):
        planes = np.frombuffer(body, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.uint64))
        at += size * width
    return out


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable by ``edges``.

    Alternating large-star and small-star steps; each is one grouping of
    O(edges) rows.  The min of a node's neighbours is an ordinary aggregate
    (pre-combined before its shuffle) joined back, so a hub's neighbours are
    never gathered into one task.  Checkpointed every round; ends when a round
    changes nothing, which takes O(log n) rounds.
    """
    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u <> v").distinct()
    pairs = fresh(pairs)
    state = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v")  # repeats leave with the last step
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        pairs = fresh(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        seen = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == state:
            break
        state = seen
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of non-blank bytes; none crosses rows."""
    solid = ~_BLANK[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1
