"""Every registered query against its DuckDB SQL on the smallest input."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidemark.plans import catalog
from tidemark.sources.tables import INPUT_TABLES, table_path

NAMES = sorted(catalog.queries())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in INPUT_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(catalog.queries())
    assert set(catalog.queries()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["order_date_key", "product_key", "country_key", "total_net_revenue",
                          "total_amount", "total_orders", "active_customers"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(catalog.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = _rows(cols, cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert got == want
