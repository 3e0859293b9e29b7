"""Every catalogue query against its DuckDB oracle at sf0.001."""
import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from finlake.plans.catalogue import queries
from finlake.plans.oracle import oracle_sql
from tests.conftest import SF_SMALL

TABLES = ["orders", "lineitem", "events"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    dcols, drows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _canon(cols, rows) == _canon(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 734  # silver rows at sf0.001
    assert "amount_usd" in df.columns
