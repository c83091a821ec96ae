"""Landing to raw loses nothing and keeps the right row, wherever a run stops."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import inplace
from tidemark.operators.publish import current
from tidemark.operators.watermark import get_watermark
from tidemark.plans import pipeline
from tidemark.sources import landing

AS_OF = dt.datetime(2024, 6, 1)
START = dt.datetime(2020, 1, 1)


def payment(key, amount, updated="2024-05-01T00:00:00+00:00", created="2024-04-01T00:00:00+00:00"):
    return {"payment_id": key, "customer_id": "c", "product": "Pro", "amount": amount, "currency": "USD", "status": "succeeded",
            "created_at": created, "updated_at": updated}


def put(folder, pages, total=None):
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(pages, 1):
        total_pages = total or len(pages)
        page = {"page": i, "page_size": 2, "total_pages": total_pages, "next_page": i + 1 if i < total_pages else None, "count": len(rows), "data": rows}
        with open(f"{folder}/page-{i}.json", "w") as f:
            f.write(json.dumps(page))


def amounts(df):
    return {r["payment_id"]: float(r["amount"]) for r in df.collect()}


def chain(spark, wh, path, as_of):
    pipeline.land(spark, wh, "payments", path, as_of, START)
    pipeline.apply_bronze(spark, wh, "payments")
    return amounts(current(spark, f"{wh}/raw", "payments"))


def test_later_landed_run_wins_whatever_the_page_positions(spark, tmp_path):
    put(f"{tmp_path}/l/run=9", [[payment("a", 1), payment("p", 10)]])
    put(f"{tmp_path}/l/run=10", [[payment("p", 20)]])
    assert chain(spark, f"{tmp_path}/wh", f"{tmp_path}/l/*", AS_OF) == {"a": 1, "p": 20}
    from tidemark.streaming.upsert_stream import run_stream
    run_stream(spark, f"{tmp_path}/l/*", "payments", f"{tmp_path}/ck", f"{tmp_path}/s")
    assert amounts(current(spark, f"{tmp_path}/s", "payments")) == {"a": 1, "p": 20}


@pytest.mark.parametrize("break_it", ["missing", "truncated", "short"])
def test_incomplete_pages_stop_the_run_before_the_mark(spark, tmp_path, break_it):
    folder = f"{tmp_path}/l"
    put(folder, [[payment("a", 1)], [payment("b", 2)]], total=3 if break_it == "missing" else 2)
    if break_it == "truncated":
        text = open(f"{folder}/page-2.json").read()
        open(f"{folder}/page-2.json", "w").write(text[:-20])
    if break_it == "short":
        text = open(f"{folder}/page-2.json").read()
        open(f"{folder}/page-2.json", "w").write(text.replace('"count": 1', '"count": 2'))
    with pytest.raises(Exception, match="incomplete|FAILFAST|MALFORMED"):
        pipeline.land(spark, f"{tmp_path}/wh", "payments", folder, AS_OF, START)
    assert get_watermark(spark, f"{tmp_path}/wh", "wm_payments", START) == START
    assert landing.read_bronze(spark, f"{tmp_path}/wh/bronze", "payments").count() == 0


@pytest.mark.parametrize("in_place", [False, True])
def test_stop_after_landing_is_taken_up_by_the_next_run(spark, tmp_path, in_place):
    wh = f"{tmp_path}/wh"
    put(f"{tmp_path}/l/run=1", [[payment("a", 1)]])
    pipeline.land(spark, wh, "payments", f"{tmp_path}/l/*", AS_OF, START)   # stopped here
    later = AS_OF + dt.timedelta(hours=1)
    report = pipeline.run_entity(spark, wh, "payments", f"{tmp_path}/l/*", later, in_place=in_place)
    assert report["land_payments"]["rows"] == 0
    assert amounts(pipeline.read_raw(spark, wh, "payments", in_place)) == {"a": 1}


def test_stop_after_raw_repeats_without_change(spark, tmp_path, monkeypatch):
    wh = f"{tmp_path}/wh"
    put(f"{tmp_path}/l/run=1", [[payment("a", 1)]])
    pipeline.land(spark, wh, "payments", f"{tmp_path}/l/*", AS_OF, START)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(pipeline, "set_watermark", stop)
        with pytest.raises(RuntimeError):
            pipeline.apply_bronze(spark, wh, "payments")      # raw written, its mark not
    put(f"{tmp_path}/l/run=2", [[payment("a", 5, "2024-05-02T00:00:00+00:00"), payment("b", 2, "2024-05-02T00:00:00+00:00")]])
    assert chain(spark, wh, f"{tmp_path}/l/*", AS_OF + dt.timedelta(hours=1)) == {"a": 5, "b": 2}
    assert pipeline.apply_bronze(spark, wh, "payments") is None


def test_stop_before_the_landing_mark_lands_again(spark, tmp_path, monkeypatch):
    wh = f"{tmp_path}/wh"
    put(f"{tmp_path}/l/run=1", [[payment("a", 1)]])
    with monkeypatch.context() as m:
        m.setattr(pipeline, "set_watermark", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            pipeline.land(spark, wh, "payments", f"{tmp_path}/l/*", AS_OF, START)
    assert chain(spark, wh, f"{tmp_path}/l/*", AS_OF + dt.timedelta(hours=1)) == {"a": 1}


def test_mark_takes_the_first_time_that_is_there(spark, tmp_path):
    wh = f"{tmp_path}/wh"
    put(f"{tmp_path}/l", [[payment("a", 1, updated=None, created="2024-05-03T00:00:00+00:00"), payment("b", 2, updated="")]])
    assert chain(spark, wh, f"{tmp_path}/l", AS_OF) == {"a": 1, "b": 2}
    assert get_watermark(spark, wh, "wm_payments", START) == dt.datetime(2024, 5, 3, 0, 0, 0, 1)


def test_null_key_stops_the_load(spark, tmp_path):
    wh = f"{tmp_path}/wh"
    put(f"{tmp_path}/l", [[payment(None, 1), payment("b", 2)]])
    pipeline.land(spark, wh, "payments", f"{tmp_path}/l", AS_OF, START)
    with pytest.raises(Exception, match="NULL payment_id"):
        pipeline.apply_bronze(spark, wh, "payments")
    assert current(spark, f"{wh}/raw", "payments") is None


def test_another_bucket_count_is_refused(spark, tmp_path):
    df = spark.range(200).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    path = f"{tmp_path}/t"
    inplace.upsert_buckets(spark, path, df, "k", buckets=16, order=None)
    with pytest.raises(ValueError, match="16 buckets"):
        inplace.upsert_buckets(spark, path, df, "k", buckets=64, order=None)
    inplace.upsert_buckets(spark, path, df, "k", buckets=16, order=None)
    assert inplace.read_bucketed(spark, path).count() == 200
