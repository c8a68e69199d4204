"""XPT source: round trip through our test writer; 1 vs N splits identical."""

from __future__ import annotations

import os

import numpy as np
import pytest

from stratiform.sources.xpt import ibm_to_double, read_layout, read_xpt
from xpt_writer import double_to_ibm, write_xpt


@pytest.mark.parametrize("x", [0.0, 1.0, -1.0, 2.5, 9999.0, 0.1, 123456.789, 1e-5, 5.5e10, -0.375])
def test_ibm_round_trip(x):
    raw = np.frombuffer(double_to_ibm(x), dtype=np.uint8).reshape(1, 8)
    assert ibm_to_double(raw)[0] == pytest.approx(x, rel=1e-15)


def test_missing_codes():
    raw = np.frombuffer(b"." + b"\0" * 7 + b"A" + b"\0" * 7, dtype=np.uint8).reshape(2, 8)
    assert np.isnan(ibm_to_double(raw)).all()


def make_file(path, n):
    rng = np.random.default_rng(1)
    cols = {
        "_STATE": [float(v) for v in rng.integers(1, 57, n)],
        "DIABETE4": [None if i % 17 == 0 else float(1 + i % 4) for i in range(n)],
        "_LLCPWT": [float(v) for v in rng.uniform(1, 5000, n).round(4)],
        "NAME": [f"r{i}" for i in range(n)],
    }
    write_xpt(path, cols, char_lengths={"NAME": 6})
    return cols


def test_layout_and_padding(scratch_dir):
    p = os.path.join(scratch_dir, "LLCP2022.XPT")
    make_file(p, 3)  # 30-byte records: trailing blank padding must not be read as rows
    lay = read_layout(p)
    assert lay.n_records == 3 and lay.record_length == 30
    assert [v.name for v in lay.variables] == ["_STATE", "DIABETE4", "_LLCPWT", "NAME"]


def test_read_values_and_splits(spark, scratch_dir):
    p = os.path.join(scratch_dir, "LLCP2021.XPT")
    cols = make_file(p, 2003)
    one = read_xpt(spark, p, with_record_no=True, partition_bytes=1 << 30)
    many = read_xpt(spark, p, with_record_no=True, partition_bytes=30 * 100)
    assert many.rdd.getNumPartitions() > 10
    a, b = sorted(one.collect(), key=lambda r: r.record_no), sorted(many.collect(), key=lambda r: r.record_no)
    assert a == b and len(a) == 2003
    rows = {r.record_no: r for r in one.collect()}
    assert rows[0]["DIABETE4"] is None and rows[1]["DIABETE4"] == cols["DIABETE4"][1]
    assert rows[5]["_LLCPWT"] == cols["_LLCPWT"][5] and rows[7]["NAME"] == "r7"


def test_column_pruned_read(spark, scratch_dir):
    p = os.path.join(scratch_dir, "LLCP2023.XPT")
    make_file(p, 50)
    df = read_xpt(spark, p, columns=["_LLCPWT", "NOT_THERE"])
    assert df.columns == ["_LLCPWT"] and df.count() == 50


def test_uri_directory_and_glob_paths(spark, scratch_dir):
    for y in (2021, 2022):
        make_file(os.path.join(scratch_dir, f"LLCP{y}.XPT"), 20)
    assert read_xpt(spark, "file://" + scratch_dir).count() == 40
    assert read_xpt(spark, scratch_dir + "/LLCP2022.*").count() == 20
    assert read_layout("file:" + os.path.join(scratch_dir, "LLCP2021.XPT")).n_records == 20


def test_vectorised_writer_matches_scalar(spark, scratch_dir):
    from xpt_writer import doubles_to_ibm, write_xpt_numeric

    vals = [0.0, 1.0, -2.5, 9999.0, 0.1, float("nan"), 123456.789, -1e-7]
    enc = doubles_to_ibm(np.array(vals))
    for i, v in enumerate(vals):
        assert bytes(enc[i]) == double_to_ibm(None if v != v else v)
    p = os.path.join(scratch_dir, "LLCP2020.XPT")
    write_xpt_numeric(p, {"A": np.array(vals), "B": np.arange(len(vals), dtype=float)})
    rows = sorted(read_xpt(spark, p, with_record_no=True).collect(), key=lambda r: r.record_no)
    assert [r.B for r in rows] == list(range(len(vals)))
    assert rows[5].A is None and rows[2].A == -2.5


def test_a_last_record_of_blanks_is_data(spark, scratch_dir):
    p = os.path.join(scratch_dir, "blank.xpt")
    write_xpt(p, {"NOTE": ["a" * 100, "b", ""]}, char_lengths={"NOTE": 100})
    assert read_layout(p).n_records == 3 and read_xpt(spark, p).count() == 3
    write_xpt(p, {"NOTE": ["a", "b", "c"]}, char_lengths={"NOTE": 30})
    assert read_layout(p).n_records == 3


def test_only_the_header_is_read_for_the_layout(scratch_dir, monkeypatch):
    from stratiform.sources import xpt

    p = os.path.join(scratch_dir, "wide.xpt")
    write_xpt(p, {f"V{i}": [float(i)] for i in range(300)})
    read, plain = [], xpt._read_range
    monkeypatch.setattr(xpt, "_read_range", lambda path, at, n: read.append(n) or plain(path, at, n))
    layout = read_layout(p)
    assert len(layout.variables) == 300 and layout.n_records == 1
    assert sum(read) == layout.data_offset  # no padding can be a whole record here


def test_a_second_member_is_an_error(spark, scratch_dir):
    p, q = os.path.join(scratch_dir, "one.xpt"), os.path.join(scratch_dir, "two.xpt")
    make_file(p, 400)
    make_file(q, 50)
    with open(p, "ab") as out, open(q, "rb") as more:
        out.write(more.read()[3 * 80 :])
    for size in (1 << 20, 3000):
        with pytest.raises(Exception, match="second member"):
            read_xpt(spark, p, partition_bytes=size).collect()


def test_batches_of_a_split_are_bounded(spark, scratch_dir, monkeypatch):
    from stratiform.sources import xpt

    p = os.path.join(scratch_dir, "LLCP2022.XPT")
    make_file(p, 500)
    monkeypatch.setattr(xpt, "BATCH_BYTES", 3000)
    layout = read_layout(p)
    reader = xpt.XptReader(xpt._schema_for(layout), {"path": p})
    batches = [b for part in reader.partitions() for b in reader.read(part)]
    assert len(batches) == 5 and sum(b.num_rows for b in batches) == 500
