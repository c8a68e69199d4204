"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from oracle_compare import compare_rows, duck

from conftest import SF_ORACLE, SF_SMOKE

QUERIES = entry_module.queries()
ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(ORACLE) <= set(QUERIES)
    from stratiform.plans import registry

    assert len(registry.oracle_sql()) >= len(registry.queries()) - 2


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and df.columns == ["l_returnflag", "l_linestatus", "ship_year", "n_rows", "weighted_n",
                                             "prop_discounted"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    cur = con.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    idx = [dcols.index(c) for c in df.columns]
    drows = [tuple(r[i] for i in idx) for r in cur.fetchall()]
    rows = [tuple(r) for r in df.collect()]
    assert compare_rows(rows, drows) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMOKE).count() >= 0
