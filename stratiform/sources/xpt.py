"""SAS transport (XPORT v5) files as a splittable Spark data source.

``spark.read.format("xpt").load(path)`` reads one file, a directory or a
glob.  The driver reads only each file's header (a few KB) to learn the
variables and the record length; the data area is cut into record-aligned
byte ranges, one input partition each, so a 200 MB yearly file is decoded by
many tasks in parallel.  Each task reads its byte range, views it as an
``(n, record_length)`` byte matrix and decodes the requested columns with
numpy (big-endian IBM/370 floating point -> IEEE double, missing-value codes
-> NULL, character fields -> trimmed text), yielding Arrow record batches.

Only the columns of the read schema are decoded: pass ``.schema(...)`` (or
select before any action with a user schema) to skip the rest.  The special
column ``record_no`` (BIGINT, 0-based position in the file) and ``source_file``
(STRING) can be requested; ``record_no`` is a free deterministic key.
``file_year`` (INT) is the year in the file's name, NULL without one.

Options prune the scan: ``years`` (files of other years, by name, are not
opened) and ``firstRecord``/``lastRecord`` (a half-open range that cuts the byte
ranges).  They are options and no pushed filters because Spark 4.1 keeps a
pruned Python reader for later queries on the same frame, which would then miss
rows; a filter on ``file_year`` or ``record_no`` is right, but reads all files.
A file that ends inside a record is an error, not a shorter table.

Paths may be local or URIs of any file system Arrow can open (``file://``,
``s3://``, ``gs://``, ``hdfs://``): each task opens the file itself and reads
only its byte range, so nothing is staged through the driver.
"""

from __future__ import annotations

import fnmatch
import re
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

RECORD = 80
NAMESTR_TAG = b"HEADER RECORD*******NAMESTR HEADER RECORD!!!!!!!"
OBS_TAG = b"HEADER RECORD*******OBS     HEADER RECORD!!!!!!!"
MEMBER_TAG = b"HEADER RECORD*******MEMBER  HEADER RECORD!!!!!!!"
HEADER_BYTES = 8 * RECORD + 8 * 140  # first read; the rest follows from the variable count
BATCH_BYTES = 4 << 20  # source bytes decoded into one Arrow batch
# First bytes that mark a missing numeric ('.', '_', 'A'-'Z').
MISSING_FIRST_BYTES = bytes([0x2E, 0x5F, *range(0x41, 0x5B)])
RECORD_NO = "record_no"
SOURCE_FILE = "source_file"
FILE_YEAR = "file_year"
_YEAR_IN_NAME = re.compile(r"(\d{4})\.[^.]*$")
DEFAULT_PARTITION_BYTES = 64 << 20


@dataclass(frozen=True)
class Variable:
    name: str
    numeric: bool
    length: int
    position: int


@dataclass(frozen=True)
class Layout:
    path: str
    variables: tuple[Variable, ...]
    record_length: int
    data_offset: int
    n_records: int


def _resolve(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path inside it) for a local path or a URI."""
    if path.startswith("file:"):
        rest = path[len("file:"):]
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _uri(fs: pafs.FileSystem, path: str, like: str) -> str:
    """Re-attach the scheme of ``like`` to a path listed inside ``fs``."""
    if "://" in like and not like.startswith("file:"):
        return like.split("://", 1)[0] + "://" + path.lstrip("/")
    return path


def _read_range(path: str, offset: int, nbytes: int) -> bytes:
    fs, p = _resolve(path)
    with fs.open_input_file(p) as fh:
        return fh.read_at(nbytes, offset) if nbytes > 0 else b""


def _size(path: str) -> int:
    fs, p = _resolve(path)
    return fs.get_file_info(p).size


def _parse_namestr(raw: bytes, namestr_len: int) -> Variable:
    ntype, _hfun, length, _varnum = struct.unpack(">hhhh", raw[:8])
    name = raw[8:16].decode("ascii", "replace").strip()
    position = struct.unpack(">i", raw[84:88])[0]
    return Variable(name=name, numeric=ntype == 1, length=length, position=position)


def _header(path: str, size: int) -> tuple[bytes, int, int, int]:
    """Header bytes up to the first observation, the variable count, the place
    of the first variable record and the length of each."""
    head = _read_range(path, 0, min(size, HEADER_BYTES))
    if not head.startswith(b"HEADER RECORD*******LIBRARY HEADER RECORD"):
        raise ValueError(f"{path}: not a SAS transport (XPORT v5) file")
    m, n = head.find(MEMBER_TAG), head.find(NAMESTR_TAG)
    if n < 0 or len(head) < n + RECORD:
        raise ValueError(f"{path}: no variable header in the first {HEADER_BYTES} bytes")
    each = int(head[m + 74 : m + 78]) if m >= 0 else 140
    count = int(head[n + 54 : n + 58])
    end = n + RECORD + -(-count * each // RECORD) * RECORD + RECORD  # padded to whole records, then the OBS header
    if end > len(head):
        head += _read_range(path, len(head), min(end, size) - len(head))
    if head[end - RECORD : end - RECORD + len(OBS_TAG)] != OBS_TAG:
        raise ValueError(f"{path}: no observation header after {count} variables")
    return head[:end], count, n + RECORD, each


def read_layout(path: str) -> Layout:
    """Parse the header of an XPORT file with one member (driver side).

    Only the header itself is read: its size follows from the variable count.
    """
    size = _size(path)
    head, count, start, each = _header(path, size)
    variables = tuple(_parse_namestr(head[start + i * each : start + (i + 1) * each], each) for i in range(count))
    record_length = max(v.position + v.length for v in variables) if variables else 0
    data_offset = len(head)
    n_records, rest = divmod(size - data_offset, record_length) if record_length else (0, 0)
    # What follows the last record is padding; anything else is a cut file.
    end = _read_range(path, size - rest, rest) if 0 < rest < RECORD else b""
    if size % RECORD or rest >= RECORD or end.strip(b" "):
        raise ValueError(f"{path}: the file ends inside a record ({rest} bytes after {n_records} whole records of {record_length})")
    # Blanks fill the file up to a multiple of 80 bytes.  At most 79 of them,
    # so only that many bytes can be whole padding records; a blank record
    # before those is data.
    padding = min(n_records, (RECORD - 1) // record_length) if record_length else 0
    if padding:
        tail = _read_range(path, data_offset + (n_records - padding) * record_length, padding * record_length)
        for i in range(padding - 1, -1, -1):
            if tail[i * record_length : (i + 1) * record_length].strip(b" "):
                break
            n_records -= 1
    return Layout(path, variables, record_length, data_offset, n_records)


def ibm_to_double(block: np.ndarray) -> np.ndarray:
    """Decode an ``(n, k)`` uint8 array of big-endian IBM/370 floats (k <= 8).

    Returns float64 with NaN where the value is a SAS missing code.
    """
    n, k = block.shape
    full = np.zeros((n, 8), dtype=np.uint8)
    full[:, :k] = block
    u = full.view(">u8").reshape(n).astype(np.uint64)
    first = full[:, 0]
    rest_zero = ~np.any(full[:, 1:], axis=1)
    missing = np.isin(first, np.frombuffer(MISSING_FIRST_BYTES, dtype=np.uint8)) & rest_zero
    sign = np.where((u >> np.uint64(63)) != 0, -1.0, 1.0)
    exponent = ((u >> np.uint64(56)) & np.uint64(0x7F)).astype(np.int64)
    mantissa = (u & np.uint64(0x00FFFFFFFFFFFFFF)).astype(np.float64)
    value = sign * np.ldexp(mantissa, (4 * (exponent - 64) - 56).astype(np.int32))
    value[mantissa == 0] = 0.0
    value[missing] = np.nan
    return value


def _schema_for(layout: Layout) -> StructType:
    return StructType(
        [StructField(v.name, DoubleType() if v.numeric else StringType(), True) for v in layout.variables]
    )


def _expand(path: str) -> list[str]:
    """A file, a directory (its ``*.xpt`` files) or a glob in the last path part."""
    fs, p = _resolve(path)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.Directory:
        found = fs.get_file_info(pafs.FileSelector(p))
        files = [f.path for f in found if f.type == pafs.FileType.File and f.path.lower().endswith(".xpt")]
    elif any(ch in p for ch in "*?["):
        parent, pattern = p.rsplit("/", 1) if "/" in p else (".", p)
        found = fs.get_file_info(pafs.FileSelector(parent))
        files = [f.path for f in found if f.type == pafs.FileType.File
                 and fnmatch.fnmatch(f.path.rsplit("/", 1)[-1], pattern)]
    else:
        files = [p]
    return sorted(_uri(fs, f, path) for f in files)


class XptPartition(InputPartition):
    def __init__(self, layout: Layout, first: int, last: int):
        super().__init__((layout.path, first, last))
        self.layout = layout
        self.first = first
        self.last = last


def _option_paths(options: dict) -> list[str]:
    """``path`` (file, directory or glob) or ``paths`` (newline-separated), of
    the ``years`` asked for (comma-separated)."""
    raw = options.get("paths") or options["path"]
    files = {f for p in raw.split("\n") if p for f in _expand(p)}
    return _of_years(files, [int(y) for y in options["years"].split(",")] if options.get("years") else None)


def _of_years(files, years: list[int] | None) -> list[str]:
    return sorted(f for f in files if years is None or file_year(f) in years)


def file_year(path: str) -> int | None:
    """The four digits before the extension of a file's name."""
    found = _YEAR_IN_NAME.search(path.rsplit("/", 1)[-1])
    return int(found[1]) if found else None


class XptReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema = schema
        self.paths = _option_paths(options)
        self.partition_bytes = int(options.get("partitionBytes", DEFAULT_PARTITION_BYTES))
        self.first, self.last = int(options.get("firstRecord", 0)), options.get("lastRecord")

    def partitions(self):
        parts = []
        for p in self.paths:
            layout = read_layout(p)
            end = layout.n_records if self.last is None else min(int(self.last), layout.n_records)
            per = max(1, self.partition_bytes // layout.record_length) if layout.record_length else 1
            for first in range(self.first, end, per):
                parts.append(XptPartition(layout, first, min(first + per, end)))
        return parts

    def read(self, partition: XptPartition):
        """Bounded batches of a split."""
        if partition is None:  # Spark's stand-in where no file has a record to read
            return
        layout = partition.layout
        per = max(1, BATCH_BYTES // layout.record_length)
        for first in range(partition.first, partition.last, per):
            yield self._batch(layout, first, min(first + per, partition.last))

    def _batch(self, layout: Layout, first: int, last: int) -> pa.RecordBatch:
        n = last - first
        size = n * layout.record_length
        # A few bytes more, so that a header across two batches is seen.
        data = _read_range(layout.path, layout.data_offset + first * layout.record_length, size + len(MEMBER_TAG) - 1)
        if MEMBER_TAG in data:
            raise ValueError(f"{layout.path}: a second member begins after record {first}; one member a file is read")
        rows = np.frombuffer(data, dtype=np.uint8, count=size).reshape(n, layout.record_length)
        by_name = {v.name.lower(): v for v in layout.variables}
        arrays, names = [], []
        for field in self.schema.fields:
            key = field.name.lower()
            if key == RECORD_NO:
                arrays.append(pa.array(np.arange(first, last, dtype=np.int64)))
            elif key == SOURCE_FILE:
                arrays.append(pa.array([layout.path] * n, type=pa.string()))
            elif key == FILE_YEAR:
                arrays.append(pa.array([file_year(layout.path)] * n, type=pa.int32()))
            elif key not in by_name:
                arrays.append(pa.nulls(n, type=pa.float64() if isinstance(field.dataType, DoubleType) else pa.string()))
            else:
                v = by_name[key]
                block = rows[:, v.position : v.position + v.length]
                if v.numeric:
                    vals = ibm_to_double(np.ascontiguousarray(block))
                    arrays.append(pa.array(vals, mask=np.isnan(vals), type=pa.float64()))
                else:
                    fixed = np.ascontiguousarray(block).view(f"S{v.length}").reshape(n)
                    text = np.char.rstrip(np.char.decode(fixed, "latin-1"), " \x00")
                    arrays.append(pa.array(text, mask=text == "", type=pa.string()))
            names.append(field.name)
        return pa.RecordBatch.from_arrays(arrays, names=names)


class XptDataSource(DataSource):
    """``format("xpt")``: options ``path`` and ``partitionBytes``."""

    @classmethod
    def name(cls) -> str:
        return "xpt"

    def schema(self):
        paths = _option_paths(self.options)
        if not paths:
            raise FileNotFoundError(self.options.get("paths") or self.options["path"])
        return _schema_for(read_layout(paths[0]))

    def reader(self, schema: StructType) -> XptReader:
        return XptReader(schema, self.options)


def register(spark) -> None:
    """Register the ``xpt`` format on a session."""
    spark.dataSource.register(XptDataSource)


MIN_PARTITION_BYTES = 4 << 20


def split_bytes(spark, total_bytes: int) -> int:
    """Split size like Spark's file sources: ``min(maxPartitionBytes,
    max(4 MB, total / defaultParallelism))`` -- every core gets work on small
    inputs, and splits stay bounded on large ones."""
    try:
        conf = spark.conf.get("spark.sql.files.maxPartitionBytes", str(DEFAULT_PARTITION_BYTES))
        max_bytes = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf))
        cores = max(1, spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no JVM context (Spark Connect)
        return DEFAULT_PARTITION_BYTES
    return int(min(max_bytes, max(MIN_PARTITION_BYTES, total_bytes // cores)))


def read_xpt(spark, path: str | list[str], columns: list[str] | None = None, with_record_no: bool = False,
             partition_bytes: int | None = None, with_source_file: bool = False, with_file_year: bool = False,
             years: list[int] | None = None, records: tuple[int, int] | None = None):
    """Read XPORT file(s) -- one path (file, directory, glob) or a list -- in one scan.

    ``columns`` limits decoding to those variables (case-insensitive); with
    several files the schema is the union of their variables, and a file
    without a variable yields NULL for it.  ``years`` and ``records`` (a
    half-open range of record numbers) prune the scan.
    """
    register(spark)
    paths = [path] if isinstance(path, str) else list(path)
    files = _of_years({f for p in paths for f in _expand(p)}, years)
    if not files:
        raise FileNotFoundError(paths)
    if partition_bytes is None:
        partition_bytes = split_bytes(spark, sum(_size(f) for f in files))
    reader = spark.read.format("xpt").option("partitionBytes", str(partition_bytes))
    reader = reader.option("paths", "\n".join(files))
    if records is not None:
        reader = reader.option("firstRecord", str(records[0])).option("lastRecord", str(records[1]))
    if columns is not None or with_record_no or with_source_file or with_file_year or len(files) > 1:
        wanted = {c.lower() for c in columns} if columns is not None else None
        fields: dict[str, StructField] = {}
        for f in files:
            for field in _schema_for(read_layout(f)).fields:
                if (wanted is None or field.name.lower() in wanted) and field.name.lower() not in fields:
                    fields[field.name.lower()] = field
        order = {c.lower(): i for i, c in enumerate(columns)} if columns is not None else {}
        out = sorted(fields.values(), key=lambda fld: order.get(fld.name.lower(), len(order)))
        if with_record_no:
            out.append(StructField(RECORD_NO, LongType(), False))
        if with_source_file:
            out.append(StructField(SOURCE_FILE, StringType(), False))
        if with_file_year:
            out.append(StructField(FILE_YEAR, IntegerType(), True))
        reader = reader.schema(StructType(out))
    return reader.load()
