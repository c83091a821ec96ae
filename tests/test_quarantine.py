"""Rows that do not fit are set aside with a reason; the rest of the load goes on."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators.quality import same_rows
from tidemark.plans.gold import Build
from tidemark.schemas import ENTITY_JSON
from tidemark.sources import landing, quarantine as q

ORDER_COLS = {"ingestion_ts": "2024-06-01", "landed": "run=1", "page": 1, "pos": 0}


def landed(spark, rows, entity="payments"):
    names = [f.name for f in ENTITY_JSON[entity].fields]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ENTITY_JSON[entity])
    return df.withColumns({c: F.lit(v) for c, v in ORDER_COLS.items()})


def payment(i, **over):
    return {"payment_id": f"p{i}", "customer_id": "c", "amount": 10.0 + i, "created_at": "2024-05-01T10:00:00+00:00",
            "updated_at": "2024-05-02T10:00:00+00:00", **over}


def test_a_malformed_time_does_not_stop_the_load(spark, scratch):
    rows = [payment(1), payment(2, created_at="yesterday"), payment(3, amount=float("nan")), payment(4, payment_id=None),
            payment(5, updated_at=""), payment(6, amount=1e30, created_at="2024-13-45"), payment(7, amount=None)]
    stats = q.write_split(landed(spark, rows), scratch, "payments")
    assert (stats["rows"], stats["good"], stats["rejected"]) == (7, 2, 5)
    good = q.read_good(spark, scratch, stats["run"], "payments")
    assert sorted(r["payment_id"] for r in good.collect()) == ["p1", "p7"]
    counts = {(r["column"], r["reason"]): r["n"] for r in q.problem_counts(spark, scratch, stats["run"], "payments").collect()}
    assert counts == {("created_at", "not a time"): 2, ("amount", "not an amount"): 2, ("payment_id", "missing"): 1, ("updated_at", "missing"): 1}
    bad = q.read_rejected(spark, scratch, stats["run"], "payments")
    assert {r["payment_id"]: r["created_at"] for r in bad.collect()}["p2"] == "yesterday"      # as it was landed


def test_redrive_after_repair(spark, scratch):
    rows = [payment(1), payment(2, created_at="01.05.2024"), payment(3, created_at="never")]
    first = q.write_split(landed(spark, rows), scratch, "payments")
    fix = lambda df: df.withColumn("created_at", F.when(F.col("created_at").rlike(r"^\d\d\.\d\d\.\d{4}$"),
                                                       F.date_format(F.to_date("created_at", "dd.MM.yyyy"), "yyyy-MM-dd'T'00:00:00+00:00")).otherwise(F.col("created_at")))
    second = q.redrive(spark, scratch, first["run"], "payments", fix)
    assert (second["rows"], second["good"], second["rejected"]) == (2, 1, 1)
    again = q.read_good(spark, scratch, second["run"], "payments").collect()
    assert [(r["payment_id"], str(r["created_at"]), r["pos"]) for r in again] == [("p2", "2024-05-01 00:00:00", 0)]
    assert q.redrive(spark, scratch, q.write_split(landed(spark, rows[:1]), scratch, "payments")["run"], "payments", fix) is None


@pytest.mark.parametrize("entity", ["customers", "payments", "sessions"])
def test_clean_rows_come_out_as_before(spark, scratch, entity):
    raw = getattr(Build(spark, SF_SMALL), f"raw_{entity}")
    rows = landing.to_service_rows(raw, entity).withColumns({c: F.lit(v) for c, v in ORDER_COLS.items()})
    stats = q.write_split(rows, scratch, entity)
    assert stats["rejected"] == 0 and stats["good"] == stats["rows"] == raw.count()
    assert same_rows(q.read_good(spark, scratch, stats["run"], entity), landing.to_raw(rows, entity, keep=landing.BRONZE_ORDER))


def test_flags_and_empty_input(spark, scratch):
    rows = [{"session_id": "s1", "session_start": "2024-01-01T00:00:00+00:00", "bounced": 2}, {"session_id": "s2", "session_start": "2024-01-01T00:00:00+00:00"}]
    stats = q.write_split(landed(spark, rows, "sessions"), scratch, "sessions")
    assert (stats["good"], stats["rejected"]) == (1, 1)
    assert q.read_good(spark, scratch, stats["run"], "sessions").first()["bounced"] == 0
    none = q.write_split(landed(spark, [], "sessions"), scratch, "sessions")
    assert none["rows"] == 0 and q.read_good(spark, scratch, none["run"], "sessions").count() == 0
