"""Minimal SAS XPORT v5 writer used only to build test fixtures.

Writes one member with numeric (8-byte IBM/370 float) and character
variables.  ``None``/NaN numerics are written as the standard missing code.
"""

from __future__ import annotations

import math
import struct

STAMP = b"01JAN24:00:00:00"


def _pad(b: bytes, n: int, fill: bytes = b" ") -> bytes:
    return b[:n].ljust(n, fill)


def double_to_ibm(x: float | None) -> bytes:
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return b"." + b"\x00" * 7
    if x == 0:
        return b"\x00" * 8
    sign = 0x80 if x < 0 else 0
    m, e2 = math.frexp(abs(x))  # abs(x) = m * 2**e2, 0.5 <= m < 1
    # move to base 16: abs(x) = f * 16**e16 with 1/16 <= f < 1
    e16 = (e2 + 3) // 4
    shift = 4 * e16 - e2  # 0..3
    f = m / (2 ** shift)
    mant = int(round(f * (1 << 56)))
    if mant >= 1 << 56:
        mant >>= 4
        e16 += 1
    return bytes([sign | (e16 + 64)]) + mant.to_bytes(7, "big")


def doubles_to_ibm(values) -> "np.ndarray":
    """Vectorised ``double_to_ibm``: float64 array (NaN = missing) -> (n, 8) uint8."""
    import numpy as np

    x = np.asarray(values, dtype=np.float64)
    n = x.shape[0]
    out = np.zeros((n, 8), dtype=np.uint8)
    missing = np.isnan(x)
    nz = ~missing & (x != 0)
    m, e2 = np.frexp(np.abs(np.where(nz, x, 1.0)))
    e16 = (e2 + 3) // 4
    f = m / np.exp2(4 * e16 - e2)
    mant = (f * 2.0**56).astype(np.uint64)
    first = ((x < 0).astype(np.uint8) << 7) | (e16 + 64).astype(np.uint8)
    body = mant.astype(">u8").view(np.uint8).reshape(n, 8)[:, 1:]
    out[nz, 0] = first[nz]
    out[nz, 1:] = body[nz]
    out[missing, 0] = ord(".")
    return out


def write_xpt_numeric(path: str, columns: dict[str, "np.ndarray"], name: str = "DATA") -> None:
    """Fast writer for numeric-only members (numpy arrays, NaN = missing)."""
    import numpy as np

    names = list(columns)
    head = bytearray()
    write_xpt_header(head, [(c, False, 8) for c in names], name)
    n = len(next(iter(columns.values())))
    rec = np.zeros((n, 8 * len(names)), dtype=np.uint8)
    for i, c in enumerate(names):
        rec[:, 8 * i : 8 * i + 8] = doubles_to_ibm(columns[c])
    data = rec.tobytes()
    with open(path, "wb") as fh:
        fh.write(bytes(head))
        fh.write(data)
        fh.write(b" " * ((-len(data)) % 80))


def write_xpt_header(out: bytearray, layout: list[tuple[str, bool, int]], name: str = "DATA") -> None:
    rec = lambda s: out.extend(_pad(s, 80))
    rec(b"HEADER RECORD*******LIBRARY HEADER RECORD!!!!!!!000000000000000000000000000000")
    rec(b"SAS     SAS     SASLIB  9.4     X64_7PRO" + b" " * 24 + STAMP)
    rec(STAMP)
    rec(b"HEADER RECORD*******MEMBER  HEADER RECORD!!!!!!!000000000000000001600000000140")
    rec(b"HEADER RECORD*******DSCRPTR HEADER RECORD!!!!!!!000000000000000000000000000000")
    rec(b"SAS     " + _pad(name.encode(), 8) + b"SASDATA 9.4     X64_7PRO" + b" " * 24 + STAMP)
    rec(STAMP + b" " * 16 + b" " * 40 + _pad(b"", 8))
    rec(b"HEADER RECORD*******NAMESTR HEADER RECORD!!!!!!!000000" + f"{len(layout):04d}".encode()
        + b"00000000000000000000")
    namestrs = bytearray()
    pos = 0
    for i, (col, is_char, length) in enumerate(layout):
        namestrs += struct.pack(
            ">hhhh8s40s8shhh2s8shhi52s",
            2 if is_char else 1, 0, length, i + 1, _pad(col.encode(), 8), _pad(b"", 40), _pad(b"", 8),
            0, 0, 0, b"\x00\x00", _pad(b"", 8), 0, 0, pos, b"\x00" * 52,
        )
        pos += length
    namestrs += b" " * ((-len(namestrs)) % 80)
    out += namestrs
    rec(b"HEADER RECORD*******OBS     HEADER RECORD!!!!!!!000000000000000000000000000000")


def write_xpt(path: str, columns: dict[str, list], char_lengths: dict[str, int] | None = None,
              name: str = "DATA") -> None:
    """``columns``: name -> values (floats/None for numeric, str for character)."""
    char_lengths = char_lengths or {}
    names = list(columns)
    n_rows = len(next(iter(columns.values()))) if columns else 0
    out = bytearray()
    rec = lambda s: out.extend(_pad(s, 80))
    rec(b"HEADER RECORD*******LIBRARY HEADER RECORD!!!!!!!000000000000000000000000000000")
    rec(b"SAS     SAS     SASLIB  9.4     X64_7PRO" + b" " * 24 + STAMP)
    rec(STAMP)
    rec(b"HEADER RECORD*******MEMBER  HEADER RECORD!!!!!!!000000000000000001600000000140")
    rec(b"HEADER RECORD*******DSCRPTR HEADER RECORD!!!!!!!000000000000000000000000000000")
    rec(b"SAS     " + _pad(name.encode(), 8) + b"SASDATA 9.4     X64_7PRO" + b" " * 24 + STAMP)
    rec(STAMP + b" " * 16 + b" " * 40 + _pad(b"", 8))
    rec(b"HEADER RECORD*******NAMESTR HEADER RECORD!!!!!!!000000" + f"{len(names):04d}".encode()
        + b"00000000000000000000")
    namestrs = bytearray()
    pos = 0
    layout = []
    for i, col in enumerate(names):
        is_char = col in char_lengths
        length = char_lengths[col] if is_char else 8
        namestrs += struct.pack(
            ">hhhh8s40s8shhh2s8shhi52s",
            2 if is_char else 1, 0, length, i + 1, _pad(col.encode(), 8), _pad(b"", 40), _pad(b"", 8),
            0, 0, 0, b"\x00\x00", _pad(b"", 8), 0, 0, pos, b"\x00" * 52,
        )
        layout.append((col, is_char, length))
        pos += length
    namestrs += b" " * ((-len(namestrs)) % 80)
    out += namestrs
    rec(b"HEADER RECORD*******OBS     HEADER RECORD!!!!!!!000000000000000000000000000000")
    data = bytearray()
    for r in range(n_rows):
        for col, is_char, length in layout:
            v = columns[col][r]
            data += _pad((v or "").encode("latin-1"), length) if is_char else double_to_ibm(v)
    data += b" " * ((-len(data)) % 80)
    out += data
    with open(path, "wb") as fh:
        fh.write(bytes(out))
