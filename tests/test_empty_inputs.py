"""Every registered query on empty input tables (same schemas) equals its SQL."""

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tests.test_oracle import _rows
from tidemark.plans import catalog
from tidemark.sources.tables import INPUT_TABLES, table_path


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in INPUT_TABLES:
        spark.read.parquet(table_path(SF_SMALL, t)).limit(0).coalesce(1).write.parquet(table_path(d, t))
    return d


@pytest.fixture(scope="module")
def duck_empty(empty_dir):
    con = duckdb.connect()
    for t in INPUT_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(empty_dir, t)}/*.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_on_empty_inputs(spark, empty_dir, duck_empty, name):
    df = catalog.queries()[name](spark, empty_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck_empty.execute(catalog.oracle_sql()[name])
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    assert got == want
