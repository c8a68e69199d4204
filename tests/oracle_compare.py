"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: status, rows, and the first difference.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def compare_rows(a: list[tuple], b: list[tuple], rel: float = 0.0) -> str | None:
    if len(a) != len(b):
        return f"row count {len(a)} vs {len(b)}"
    a = sorted(([_norm(x) for x in r] for r in a), key=lambda r: [str(x) for x in r])
    b = sorted(([_norm(x) for x in r] for r in b), key=lambda r: [str(x) for x in r])
    for i, (ra, rb) in enumerate(zip(a, b)):
        for j, (x, y) in enumerate(zip(ra, rb)):
            if x == y:
                continue
            if isinstance(x, (int, float)) and isinstance(y, (int, float)) and not isinstance(x, bool):
                if rel and abs(x - y) <= rel * max(abs(x), abs(y), 1.0):
                    continue
            return f"row {i} col {j}: {ra} vs {rb}"
    return None


def run(sf_dir: str, names: list[str] | None = None) -> dict[str, str]:
    import __spark_entry__ as E
    from stratiform.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            out[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, out[name], flush=True)
            continue
        if name not in sqls:
            out[name] = f"rows-only {len(rows)}"
            print(f"{name:35s} rows-only rows={len(rows)} {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = [tuple(r) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            out[name] = f"DUCK ERROR {str(e)[:300]}"
            print(name, out[name], flush=True)
            continue
        if sorted(cols) != sorted(dcols):
            out[name] = f"COLUMNS {cols} vs {dcols}"
            print(name, out[name], flush=True)
            continue
        idx = [dcols.index(c) for c in cols]
        drows = [tuple(r[i] for i in idx) for r in drows]
        exact = compare_rows(rows, drows)
        status = "OK" if exact is None else ("CLOSE" if compare_rows(rows, drows, 1e-9) is None else "DIFF")
        out[name] = status if exact is None else f"{status} {exact}"
        print(f"{name:35s} {status:5s} rows={len(rows)} {time.time() - t0:.1f}s {'' if exact is None else exact[:300]}",
              flush=True)
    return out


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    run(sf, sys.argv[2:] or None)
