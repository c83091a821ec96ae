"""Landed JSON to gold, end to end, against the direct build."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators.publish import current, versions
from tidemark.operators.quality import same_rows
from tidemark.operators.watermark import get_watermark
from tidemark.plans import pipeline
from tidemark.plans.gold import Build
from tidemark.sources import landing

AS_OF = dt.datetime(2001, 8, 1)
START = dt.datetime(1990, 1, 1)
KEY = {"customers": "customer_id", "payments": "payment_id", "sessions": "session_id"}


def land_all(b, base, entities=("customers", "payments", "sessions"), where=None):
    out = {}
    for e in entities:
        raw = getattr(b, f"raw_{e}")
        if e == "customers":
            raw = raw.where(~F.col("is_deleted"))
        if where is not None:
            raw = raw.where(where)
        path = f"{base}/landing/{e}"
        landing.write_landing(landing.paginate(raw, e, KEY[e]), path)
        out[e] = path
    return out


@pytest.fixture(scope="module")
def run1(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("wh"))
    b = Build(spark, SF_SMALL)
    paths = land_all(b, base)
    report = pipeline.run(spark, f"{base}/wh", paths, AS_OF, initial_mark=START)
    return spark, base, b, paths, report


def test_staging_matches_direct_build(run1):
    spark, base, b, _, _ = run1
    stg_p = current(spark, f"{base}/wh/staging", "stg_payments")
    assert same_rows(stg_p, b.stg_payments)
    stg_s = current(spark, f"{base}/wh/staging", "stg_sessions")
    assert same_rows(stg_s, b.stg_sessions)


def test_gold_aggregates_match_direct_build(run1):
    spark, base, b, _, _ = run1
    # Tables that do not depend on which customers are live.
    for name in ("agg_sessions_daily", "dim_date", "dim_campaign", "dim_product", "dim_device"):
        assert same_rows(current(spark, f"{base}/wh/gold", name), getattr(b, name)), name


def test_live_customers_are_the_recent_ones(run1):
    spark, base, b, _, _ = run1
    cutoff = F.lit((AS_OF - dt.timedelta(days=360)).isoformat(sep=" ")).cast("timestamp_ntz")
    recent = b.raw_customers.where(~F.col("is_deleted") & (F.col("last_seen_at") >= cutoff)).select("customer_id")
    dim = current(spark, f"{base}/wh/gold", "dim_customer").select("customer_id")
    assert same_rows(dim, recent)


def test_watermark_moved_after_publish(run1):
    spark, base, b, _, report = run1
    mark = get_watermark(spark, f"{base}/wh", "wm_payments", AS_OF)
    mx = b.raw_payments.agg(F.max("updated_at")).first()[0]
    assert mark == mx + dt.timedelta(microseconds=1)
    assert report["land_payments"]["rows"] == b.raw_payments.count()
    assert report["raw_payments"][1]["table_rows"] == b.raw_payments.count()


def test_second_run_lands_nothing_and_changes_nothing(run1):
    spark, base, b, paths, _ = run1
    before = versions(spark, f"{base}/wh/raw", "payments")
    stats = pipeline.land(spark, f"{base}/wh", "payments", paths["payments"], AS_OF, START)
    assert stats["rows"] == 0
    assert versions(spark, f"{base}/wh/raw", "payments") == before


def test_stale_customers_soft_deleted(run1):
    spark, base, b, _, report = run1
    raw = current(spark, f"{base}/wh/raw", "customers")
    cutoff = AS_OF - dt.timedelta(days=360)
    assert raw.where(F.col("is_deleted")).count() == raw.where(F.col("last_seen_at") < F.lit(cutoff.isoformat(sep=" ")).cast("timestamp_ntz")).count()
    assert report["soft_delete_customers"]["deleted_rows"] > 0


def test_two_halves_equal_full_load(spark, tmp_path):
    base = str(tmp_path)
    b = Build(spark, SF_SMALL)
    cut = F.lit("1998-06-30 00:00:00").cast("timestamp_ntz")
    wh = f"{base}/wh"
    for i, cond in enumerate((F.col("updated_at") <= cut, F.col("updated_at") > cut)):
        path = f"{base}/landing/run{i}"
        landing.write_landing(landing.paginate(b.raw_payments.where(cond), "payments", "payment_id"), path)
        stats = pipeline.land(spark, wh, "payments", path, AS_OF, START)
        pipeline.bronze_to_raw(spark, wh, "payments", run=stats["run_id"])
        pipeline.refresh_staging(spark, wh, "payments")
    assert same_rows(current(spark, f"{wh}/staging", "stg_payments"), b.stg_payments)


def test_in_place_run_equals_versioned_run(run1, tmp_path):
    spark, base, b, paths, _ = run1
    wh = f"{tmp_path}/wh"
    pipeline.run(spark, wh, paths, AS_OF, initial_mark=START, in_place=True)
    for e in ("customers", "payments", "sessions"):
        a = pipeline.read_raw(spark, f"{base}/wh", e)
        c = pipeline.read_raw(spark, wh, e, in_place=True)
        assert same_rows(c.select(*a.columns), a), e
    for e in ("customers", "payments", "sessions"):
        a = current(spark, f"{base}/wh/staging", f"stg_{e}")
        c = pipeline.read_staging(spark, wh, f"stg_{e}", in_place=True)
        assert same_rows(c.select(*a.columns), a), e
    for name in ("agg_payments_daily", "agg_sessions_daily", "agg_customer_summary"):
        assert same_rows(current(spark, f"{wh}/gold", name), current(spark, f"{base}/wh/gold", name)), name


def test_in_place_two_halves_equal_full_load(spark, tmp_path):
    base = str(tmp_path)
    b = Build(spark, SF_SMALL)
    cut = F.lit("1998-06-30 00:00:00").cast("timestamp_ntz")
    wh = f"{base}/wh"
    for i, cond in enumerate((F.col("updated_at") <= cut, F.col("updated_at") > cut)):
        path = f"{base}/landing/run{i}"
        landing.write_landing(landing.paginate(b.raw_payments.where(cond), "payments", "payment_id"), path)
        stats = pipeline.land(spark, wh, "payments", path, AS_OF + dt.timedelta(hours=i), START)
        pipeline.bronze_to_raw(spark, wh, "payments", run=stats["run_id"], in_place=True)
        pipeline.refresh_staging(spark, wh, "payments", in_place=True, buckets=32)
    got = pipeline.read_staging(spark, wh, "stg_payments", in_place=True)
    assert same_rows(got.select(*b.stg_payments.columns), b.stg_payments)


def test_keep_versions_prunes_old_versions(run1, tmp_path):
    spark, base, b, paths, _ = run1
    wh = f"{tmp_path}/wh"
    pipeline.run(spark, wh, paths, AS_OF, initial_mark=START)
    report = pipeline.run(spark, wh, paths, AS_OF + dt.timedelta(days=1), initial_mark=START, keep_versions=1)
    assert report["deleted_versions"]["gold.fact_payments"] == [1]
    assert versions(spark, f"{wh}/gold", "agg_payments_daily", finished=False) == [2]
    # nothing new landed the second time: raw and staging were not rewritten
    assert report["land_payments"]["rows"] == 0
    assert versions(spark, f"{wh}/raw", "payments", finished=False) == [1]
    assert versions(spark, f"{wh}/staging", "stg_payments", finished=False) == [1]
    assert same_rows(current(spark, f"{wh}/gold", "agg_payments_daily"),
                     current(spark, f"{base}/wh/gold", "agg_payments_daily"))


def test_parallel_entity_chains_equal_sequential(run1, tmp_path):
    spark, base, b, paths, _ = run1
    wh = f"{tmp_path}/wh"
    pipeline.run(spark, wh, paths, AS_OF, initial_mark=START, parallel=True)
    for layer, name in (("staging", "stg_customers"), ("staging", "stg_payments"), ("staging", "stg_sessions"),
                        ("gold", "agg_payments_daily"), ("gold", "agg_sessions_daily"), ("gold", "dim_customer")):
        assert same_rows(current(spark, f"{wh}/{layer}", name), current(spark, f"{base}/wh/{layer}", name)), name


def test_command_line_run_and_gold(run1, tmp_path, capsys):
    import json

    from tidemark.__main__ import main
    spark, base, b, paths, _ = run1
    wh = f"{tmp_path}/wh"
    args = ["run", "--root", wh, "--as-of", AS_OF.isoformat(), "--initial-mark", START.isoformat()]
    for e, p in paths.items():
        args += ["--landing", f"{e}={p}"]
    assert main(args) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["land_payments"]["rows"] == b.raw_payments.count()
    assert main(["gold", "--root", wh]) == 0
    assert versions(spark, f"{wh}/gold", "agg_payments_daily") == [1, 2]
    assert same_rows(current(spark, f"{wh}/gold", "agg_payments_daily"),
                     current(spark, f"{base}/wh/gold", "agg_payments_daily"))


def test_first_run_with_an_empty_extract(run1, tmp_path):
    spark, base, b, paths, _ = run1
    empty = f"{tmp_path}/landing/sessions"
    import os
    os.makedirs(empty)
    open(f"{empty}/part-empty.json", "w").close()
    wh = f"{tmp_path}/wh"
    report = pipeline.run(spark, wh, {**paths, "sessions": empty}, AS_OF, initial_mark=START)
    assert report["land_sessions"]["rows"] == 0
    assert current(spark, f"{wh}/gold", "fact_sessions").count() == 0
    assert current(spark, f"{wh}/gold", "fact_payments").count() == b.raw_payments.count()


def test_published_tables_keep_their_keys(run1):
    from tidemark.operators.quality import is_key
    spark, base, b, _, _ = run1
    wh = f"{base}/wh"
    for layer, name, key in (("raw", "customers", "customer_id"), ("raw", "payments", "payment_id"),
                             ("raw", "sessions", "session_id"), ("staging", "stg_payments", "payment_id"),
                             ("staging", "stg_sessions", "session_id"), ("gold", "fact_payments", "payment_id"),
                             ("gold", "dim_customer", "customer_key")):
        assert is_key(current(spark, f"{wh}/{layer}", name), key), (layer, name)
    assert current(spark, f"{wh}/gold", "fact_sessions").count() == current(spark, f"{wh}/staging", "stg_sessions").count()
