"""Registered document queries against their DuckDB statements on the smallest scale."""

import duckdb
import pytest

from sluice.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_statement(spark, con, name):
    df = queries.queries()[name](spark, SF)
    result = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(dict(zip(columns, r))[c] for c in df.columns) for r in result.fetchall()), key=repr)
    fix = lambda v: round(v, 9) if isinstance(v, float) else v
    assert sorted((tuple(map(fix, r)) for r in df.collect()), key=repr) == sorted((tuple(map(fix, r)) for r in want), key=repr)
