"""Layer 2 of the test strategy: every SQL-expressible query equals its
independent DuckDB oracle (row count, column names, order-free value hash)."""

import pytest

from conftest import SF_ORACLE, SF_SMALL
from recoloom.plans import ORACLES
from verify import compare, duck_connect

_CON = {}


def _con(sf):
    if sf not in _CON:
        _CON[sf] = duck_connect(sf)
    return _CON[sf]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb_small(spark, name):
    r = compare(spark, name, SF_SMALL, _con(SF_SMALL))
    assert r["cols"], r
    assert r["rows"][0] == r["rows"][1], r
    assert r["hash"], r
    assert r["types"], r


@pytest.mark.parametrize("name", ["user_aggregates", "asof_features", "ranking_negatives", "knn_category",
                                  "binary_metrics", "stage_funnel"])
def test_matches_duckdb_sf001(spark, name):
    r = compare(spark, name, SF_ORACLE, _con(SF_ORACLE))
    assert r["cols"] and r["hash"] and r["types"] and r["rows"][0] == r["rows"][1], r
