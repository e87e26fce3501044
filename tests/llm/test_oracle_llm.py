"""Queries of this subpackage that have an oracle equal their DuckDB statement (sf0.001)."""

import duckdb
import pytest

from tallyrec.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "boolean": "BOOLEAN", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = QUERIES[name](spark, SMALL)
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    types = dict(zip(columns, map(str, con.sql(ORACLE_SQL[name]).types), strict=True))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in got.schema} == types
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(want.fetchall())
