"""Every registered query with an oracle equals its DuckDB statement (sf0.001)."""

import hashlib
import math

import duckdb
import pytest

from conftest import SMALL

TABLES = "customer orders events documents pages".split()
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _names():
    import __spark_entry__ as E
    from tallyrec.plans.catalog import QUERIES

    return sorted(n for n in E.oracle_sql() if n in QUERIES)  # those of removable parts are tested with them


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E

    df = E.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    oracle_types = {c: str(t) for c, t in zip(ocols, con.sql(E.oracle_sql()[name]).types)}
    assert spark_types == oracle_types
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["post_id", "cim_id", "post_order", "post_title", "permalink", "sim_score", "pred_rating",
                          "more_explore"]
