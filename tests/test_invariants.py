"""Invariants of the gold build on the mid-size input."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tidemark.operators.quality import dense_keys_ok, is_key, same_rows
from tidemark.plans.gold import Build


@pytest.fixture(scope="module")
def build(spark):
    return Build(spark, SF_MID)


@pytest.mark.parametrize("table,key", [
    ("raw_customers", "customer_id"), ("raw_payments", "payment_id"), ("raw_sessions", "session_id"),
    ("stg_customers", "customer_id"), ("stg_payments", "payment_id"), ("stg_sessions", "session_id"),
    ("fact_payments", "payment_id"), ("fact_sessions", "session_id"),
    ("dim_customer", "customer_key"), ("dim_country", "country_key"), ("dim_date", "date_key"),
])
def test_keys_unique_not_null(build, table, key):
    assert is_key(getattr(build, table), key)


@pytest.mark.parametrize("dim,key", [("dim_customer", "customer_key"), ("dim_country", "country_key"),
                                     ("dim_date", "date_key"), ("dim_device", "device_key"),
                                     ("dim_product", "product_key"), ("dim_campaign", "campaign_key")])
def test_dense_keys(build, dim, key):
    assert dense_keys_ok(getattr(build, dim), key)


def test_facts_keep_staging_rows(build):
    assert build.fact_payments.count() == build.stg_payments.count()
    assert build.fact_sessions.count() == build.stg_sessions.count()


def test_aggregates_sum_to_facts(build):
    f = build.fact_payments.agg(F.sum("net_revenue"), F.sum("amount"), F.count("payment_id")).first()
    a = build.agg_payments_daily.agg(F.sum("total_net_revenue"), F.sum("total_amount"), F.sum("total_orders")).first()
    assert tuple(f) == tuple(a)
    s = build.fact_sessions.agg(F.count("session_id"), F.sum("pageviews")).first()
    g = build.agg_sessions_daily.agg(F.sum("total_sessions"), F.sum("total_pageviews")).first()
    assert tuple(s) == tuple(g)


def test_fanout_differs_only_in_revenue(build):
    a = build.agg_customer_summary
    b = build.agg_customer_summary_fanout
    cols = [c for c in a.columns if c != "total_revenue"]
    assert same_rows(a.select(*cols), b.select(*cols))
    diff = a.alias("a").join(b.alias("b"), "customer_key").where(
        ~F.col("a.total_revenue").eqNullSafe(F.col("b.total_revenue"))).count()
    assert diff > 0


def test_summary_totals_match_facts(build):
    s = build.agg_customer_summary.agg(F.sum("total_orders"), F.sum("total_sessions")).first()
    p = build.fact_payments.where(F.col("customer_key").isNotNull()).count()
    q = build.fact_sessions.where(F.col("customer_key").isNotNull()).count()
    assert tuple(s) == (p, q)
