"""Paging envelopes, landed text rows and lineage."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.sources import landing

D = dt.datetime


def test_paginate_totals_and_next_page(spark):
    df = spark.range(1234).select(F.format_string("p%05d", "id").alias("payment_id"),
                                  F.lit("x").alias("status"))
    env = landing.paginate(df, "payments", "payment_id", 500).orderBy("page").collect()
    assert [r["page"] for r in env] == [1, 2, 3]
    assert [r["count"] for r in env] == [500, 500, 234]
    assert [r["next_page"] for r in env] == [2, 3, None]
    assert {r["total_pages"] for r in env} == {3}
    assert env[1]["data"][0]["payment_id"] == "p00500"


def test_page_size_is_capped(spark):
    df = spark.range(2500).select(F.format_string("p%05d", "id").alias("payment_id"))
    env = landing.paginate(df, "payments", "payment_id", 5000).collect()
    assert {r["page_size"] for r in env} == {1000} and len(env) == 3


def test_page_beyond_last_is_empty(spark):
    df = spark.range(10).select(F.format_string("p%05d", "id").alias("payment_id"))
    r = landing.page_totals(df, page=3, page_size=5).first()
    assert (r["total_pages"], r["next_page"], r["count"], r["total"]) == (2, None, 0, 10)
    assert landing.page_slice(df, "payment_id", 3, 5).count() == 0


def test_updated_since_on_text_skips_empty_fields(spark):
    rows = spark.createDataFrame([
        ("a", "2024-02-01T00:00:00+00:00", "2023-01-01T00:00:00+00:00"),
        ("b", "", "2024-03-01T00:00:00+00:00"),
        ("c", None, "2023-06-01T00:00:00+00:00"),
        ("d", "2024-01-01T00:00:00.000001+00:00", None)],
        "payment_id string, updated_at string, created_at string")
    got = sorted(r[0] for r in landing.updated_since_text(rows, D(2024, 1, 1)).collect())
    assert got == ["a", "b", "d"]


def test_last_seen_uses_now_for_missing_or_empty(spark):
    rows = spark.createDataFrame([("a", "2024-05-01T00:00:00+00:00", ""),
                                  ("b", "2023-05-01T00:00:00+00:00", None),
                                  ("c", "2023-05-01T00:00:00+00:00", "2024-07-01T10:00:00+02:00")],
                                 "customer_id string, updated_at string, last_seen_at string")
    out = dict(rows.select("customer_id", landing.last_seen("updated_at", "last_seen_at", D(2024, 1, 1)).alias("s")).collect())
    assert out == {"a": D(2024, 5, 1), "b": D(2024, 1, 1), "c": D(2024, 7, 1, 8)}


def test_read_envelopes_keeps_arrival_and_drops_empty_pages(spark, scratch):
    import json
    import os
    os.makedirs(f"{scratch}/l", exist_ok=True)
    pages = [{"page": 1, "page_size": 2, "total_pages": 2, "next_page": 2, "count": 2,
              "data": [{"session_id": "s1"}, {"session_id": "s2"}]},
             {"page": 2, "page_size": 2, "total_pages": 2, "next_page": None, "count": 0, "data": []}]
    with open(f"{scratch}/l/part.json", "w") as f:
        f.write("\n".join(json.dumps(p) for p in pages))
    rows = landing.read_envelopes(spark, f"{scratch}/l", "sessions").collect()
    assert [(r["session_id"], r["page"], r["pos"]) for r in rows] == [("s1", 1, 0), ("s2", 1, 1)]


def test_list_resource_filters_then_pages(spark):
    df = spark.range(100).select(F.format_string("p%03d", "id").alias("payment_id"),
                                 F.when(F.col("id") % 2 == 0, "succeeded").otherwise("failed").alias("status"))
    rows, totals = landing.list_resource(df, "payment_id", equals={"status": "failed"}, page=2, page_size=20)
    got = [r["payment_id"] for r in rows.orderBy("pos").collect()]
    assert got == [f"p{i:03d}" for i in range(41, 80, 2)]
    t = totals.first()
    assert (t["total"], t["total_pages"], t["next_page"], t["count"]) == (50, 3, 3, 20)
