"""Queries without a SQL oracle (models, ANN, greedy re-rank): they run on the
smallest tables, return rows, and keep a stable schema; plus the entry smoke."""

import pytest

from conftest import SF_SMALL
from recoloom.plans import ORACLES, QUERIES

NO_ORACLE = sorted(set(QUERIES) - set(ORACLES))


@pytest.mark.parametrize("name", NO_ORACLE)
def test_runs_with_rows(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    assert len(rows) > 0
    assert all(len(r) == len(df.columns) for r in rows)


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90
