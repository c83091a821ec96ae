"""Model rules on tiny hand-made raw rows."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.reference_forms import dense_rank_key
from tidemark.operators.keys import dense_key
from tidemark.plans import dims, facts, marts, staging
from tidemark.schemas import RAW_CUSTOMERS, RAW_PAYMENTS, RAW_SESSIONS

D = dt.datetime
M = Decimal


@pytest.fixture(scope="module")
def tiny(spark):
    cust = spark.createDataFrame([
        ("c1", "A", "PT", "SaaS", "1-10", D(2024, 1, 5), D(2024, 1, 5), False, D(2024, 1, 5), False),
        ("c2", "B", "DE", "Health", "11-50", D(2024, 2, 1), D(2024, 2, 1), True, D(2024, 2, 1), True),   # deleted
        ("c3", "C", None, "Finance", "500+", D(2024, 3, 1), D(2024, 3, 1), None, D(2024, 3, 1), None),  # NULL flag
    ], RAW_CUSTOMERS)
    pay = spark.createDataFrame([
        ("p1", "c1", "Pro", M("99.00"), "EUR", "succeeded", None, M("3.17"), "card", "PT", D(2024, 1, 6, 10), D(2024, 1, 6, 10)),
        ("p2", "c1", None, M("29.00"), "EUR", "refunded", M("29.00"), None, "card", "PT", D(2024, 1, 6, 23, 59), D(2024, 1, 7)),
        ("p3", "zz", "Basic", None, "USD", "failed", None, None, "paypal", "US", D(2024, 1, 7), D(2024, 1, 7)),
    ], RAW_PAYMENTS)
    ses = spark.createDataFrame([
        ("s1", "c1", "Google", "CPC", "product_launch", "Desktop", "PT", 3, 120, 0, 1, D(2024, 1, 6, 9), D(2024, 1, 6, 9)),
        ("s2", "", "google", "organic", "", "desktop", "US", 1, 5, 1, 0, D(2024, 1, 6, 9), D(2024, 1, 6, 9)),
        ("s3", None, "bing", "email", None, None, None, 2, 30, 0, 0, D(2024, 1, 8), D(2024, 1, 8)),
    ], RAW_SESSIONS)
    sc, sp, ss = staging.stg_customers(cust), staging.stg_payments(pay), staging.stg_sessions(ses)
    d = {
        "customer": dims.dim_customer(sc), "product": dims.dim_product(sp),
        "country": dims.dim_country(sc, sp, ss), "date": dims.dim_date(sp, ss),
        "device": dims.dim_device(ss), "campaign": dims.dim_campaign(ss),
    }
    fp = facts.fact_payments(sp, d["customer"], d["product"], d["country"], d["date"])
    fs = facts.fact_sessions(ss, d["customer"], d["country"], d["device"], d["campaign"], d["date"])
    return {"sc": sc, "sp": sp, "ss": ss, "fp": fp, "fs": fs, **d}


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_deleted_and_null_flag_customers_dropped(tiny):
    assert sorted(r["customer_id"] for r in tiny["sc"].collect()) == ["c1"]


def test_net_revenue_null_money(tiny):
    p = by(tiny["sp"], "payment_id")
    assert p["p1"]["net_revenue"] == M("95.83")          # no refund counts as 0
    assert p["p2"]["net_revenue"] == M("0.00")           # no fee counts as 0
    assert p["p3"]["net_revenue"] is None                # NULL amount stays NULL
    assert p["p2"]["order_day"] == dt.date(2024, 1, 6)


def test_sessions_blank_customer_and_case(tiny):
    s = by(tiny["ss"], "session_id")
    assert s["s2"]["customer_id"] is None
    assert (s["s1"]["source"], s["s1"]["medium"], s["s1"]["device"]) == ("google", "cpc", "desktop")
    assert s["s1"]["bounced"] is False and s["s1"]["converted"] is True


def test_dims_keep_nulls_last_and_skip_null_members(tiny):
    assert [r["device_name"] for r in tiny["device"].orderBy("device_key").collect()] == ["desktop"]
    assert [r["product_name"] for r in tiny["product"].orderBy("product_key").collect()] == ["Basic", "Pro"]
    camp = [(r["campaign_key"], r["source"], r["medium"], r["campaign"])
            for r in tiny["campaign"].orderBy("campaign_key").collect()]
    assert camp == [(1, "bing", "email", None), (2, "google", "cpc", "product_launch"), (3, "google", "organic", "")]
    assert [r["country_name"] for r in tiny["country"].orderBy("country_key").collect()] == ["PT", "US"]
    d = [(r["full_date"], r["day_of_week"]) for r in tiny["date"].orderBy("date_key").collect()]
    assert d == [(dt.date(2024, 1, 6), 6), (dt.date(2024, 1, 7), 0), (dt.date(2024, 1, 8), 1)]


def test_fact_keys_null_where_no_match(tiny):
    f = by(tiny["fp"], "payment_id")
    assert f["p3"]["customer_key"] is None              # unknown customer
    assert f["p2"]["product_key"] is None               # NULL product
    assert f["p1"]["customer_key"] == 1
    s = by(tiny["fs"], "session_id")
    assert s["s2"]["customer_key"] is None              # anonymous
    assert s["s3"]["campaign_key"] is None              # NULL campaign never matches
    assert s["s3"]["device_key"] is None and s["s3"]["country_key"] is None
    assert s["s2"]["campaign_key"] == 3                 # blank campaign is a real member


def test_daily_aggregates_keep_null_groups(tiny):
    rows = marts.agg_payments_daily(tiny["fp"]).collect()
    assert sum(r["total_orders"] for r in rows) == 3
    assert any(r["product_key"] is None for r in rows)
    s = marts.agg_sessions_daily(tiny["fs"]).collect()
    assert sum(r["total_sessions"] for r in s) == 3


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="abcXYZ", max_size=3)),
                          st.one_of(st.none(), st.integers(-5, 5))), min_size=0, max_size=60, unique=True))
def test_dense_key_equals_dense_rank(spark, rows):
    df = spark.createDataFrame(rows, "a string, b int")
    got = dense_key(df, ["a", "b"], "k", num_partitions=4).collect()
    want = dense_rank_key(df, ["a", "b"], "k").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)
