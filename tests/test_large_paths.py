"""The paths taken on large inputs give the oracle's answers too.

The broadcast bound and the rows a task should get are lowered so that the small
input takes the shuffled, salted joins.
"""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.test_oracle import _rows, duck  # noqa: F401  (fixture)

FORCED = {"tidemark.broadcast.maxBytes": "0", "tidemark.join.rowsPerTask": "50", "tidemark.hotKeys.sampleFraction": "1.0"}
NAMES = ["raw_payments", "dim_product", "dim_date", "dim_country", "dim_device", "dim_campaign",
         "fact_payments", "fact_sessions",
         "agg_payments_daily", "agg_sessions_daily", "agg_customer_summary", "upsert_customers"]


@pytest.fixture()
def forced(spark):
    old = {k: spark.conf.get(k, None) for k in FORCED}
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_forced_large_paths_match_oracle(forced, duck, name):  # noqa: F811
    df = E.queries()[name](forced, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    assert got == want
