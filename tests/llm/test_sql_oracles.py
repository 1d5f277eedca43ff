"""Corpus queries that SQL can express, against DuckDB."""

import pytest
import verify

from recoloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, name, sf):
    con = verify.duck_connect(sf)
    rel = con.execute(ORACLES[name])
    want = verify.table_digest([d[0] for d in rel.description], rel.fetchall())
    df = QUERIES[name](spark, sf)
    assert verify.table_digest(df.columns, [tuple(r) for r in df.collect()])[:3] == want[:3]
    assert not verify.type_mismatches(df, con, ORACLES[name])
