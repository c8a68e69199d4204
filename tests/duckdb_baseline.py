"""Time the oracle SQL of the bench queries on DuckDB (4 threads, as the
reference configures its embedded engine).  Prints one JSON line.

Usage: python tests/duckdb_baseline.py [sf_dir]
"""

from __future__ import annotations

import json
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from bench import HEADLINE  # noqa: E402
from oracle_compare import duck  # noqa: E402

from stratiform.plans import registry  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duck(sf_dir)
    con.execute("SET threads = 4")
    sqls = registry.oracle_sql()
    out = {}
    for name in HEADLINE:
        if name not in sqls:
            continue
        samples = []
        for i in range(4):
            t0 = time.perf_counter()
            con.execute(f"CREATE OR REPLACE TEMP TABLE timed AS {sqls[name]}")  # every column is computed
            if i:
                samples.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(samples), 4)
    print(json.dumps({"engine": "duckdb", "threads": 4, "sf": Path(sf_dir).name, "queries": out,
                      "value": round(sum(out.values()), 4)}))


if __name__ == "__main__":
    main()
