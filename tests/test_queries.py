"""Every registered query against its DuckDB oracle on the smallest scale."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from sluice.plans import queries as Q

SF = os.environ.get("SLUICE_TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    fix = lambda v: (None if math.isnan(v) else round(v, 6)) if isinstance(v, float) else v
    return sorted((tuple(fix(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(Q.queries()) == set(Q.oracle_sql()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm(rows, df.columns) == _norm(res.fetchall(), ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["on_date", "account_rk", "currency_rk", "balance_out"]
    assert df.count() > 0
