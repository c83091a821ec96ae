"""Rule tests for upsert, insert-only, merge, soft delete and the marks."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import dml
from tidemark.operators.watermark import incremental, next_mark

T = "id string, v int, updated_at timestamp_ntz, is_deleted boolean"
B = "id string, v int, updated_at timestamp_ntz, is_deleted boolean, page int, pos int"
D = dt.datetime


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*(cols or df.columns)).collect())


def test_last_arrival_wins_without_time_guard(spark):
    target = spark.createDataFrame([("a", 1, D(2024, 1, 1), True)], T)
    batch = spark.createDataFrame([("a", 2, D(2024, 5, 1), True, 1, 0), ("a", 3, D(2024, 2, 1), True, 2, 0),
                                   ("b", 9, D(2024, 1, 1), True, 1, 1)], B)
    out = dml.upsert(target, batch, "id", revive="is_deleted")
    assert rows(out) == [("a", 3, D(2024, 2, 1), False), ("b", 9, D(2024, 1, 1), False)]


def test_insert_only_keeps_target_and_first_arrival(spark):
    target = spark.createDataFrame([("a", 1, D(2024, 1, 1), False)], T)
    batch = spark.createDataFrame([("a", 5, D(2024, 5, 1), False, 1, 0), ("b", 7, D(2024, 1, 1), False, 1, 1),
                                   ("b", 8, D(2024, 1, 2), False, 2, 0)], B)
    out = dml.upsert(target, batch, "id", on_match="nothing")
    assert rows(out, "id", "v") == [("a", 1), ("b", 7)]


def test_upsert_twice_changes_nothing(spark):
    target = spark.createDataFrame([("a", 1, D(2024, 1, 1), False), ("c", 4, D(2024, 1, 1), False)], T)
    batch = spark.createDataFrame([("a", 2, D(2024, 5, 1), False, 1, 0), ("b", 3, D(2024, 5, 1), False, 1, 1)], B)
    once = dml.upsert(target, batch, "id")
    twice = dml.upsert(once, batch, "id")
    assert rows(once) == rows(twice)


def test_merge_updates_named_columns_only(spark):
    target = spark.createDataFrame([("a", 1, D(2024, 1, 1), False)], T)
    batch = spark.createDataFrame([("a", 9, D(2024, 2, 1), True), ("b", 5, D(2024, 2, 1), True)], T)
    out = dml.merge(target, batch, "id", update_cols=["v"])
    assert rows(out) == [("a", 9, D(2024, 1, 1), False), ("b", 5, D(2024, 2, 1), True)]


def test_merge_rejects_duplicate_batch_keys(spark):
    target = spark.createDataFrame([("a", 1, D(2024, 1, 1), False)], T)
    batch = spark.createDataFrame([("b", 1, D(2024, 1, 1), False), ("b", 2, D(2024, 1, 1), False)], T)
    with pytest.raises(Exception, match="duplicate"):
        dml.merge(target, batch, "id").collect()


def test_soft_delete_flags_stale_live_rows_and_counts(spark):
    s = "id string, last_seen_at timestamp_ntz, updated_at timestamp_ntz, is_deleted boolean"
    df = spark.createDataFrame([("old", D(2020, 1, 1), D(2020, 1, 1), False),
                                ("new", D(2024, 12, 1), D(2024, 12, 1), False),
                                ("gone", D(2019, 1, 1), D(2019, 1, 1), True),
                                ("never", None, D(2019, 1, 1), False)], s)
    obs = Observation("sd")
    out = dml.soft_delete(df, D(2025, 1, 1), 360, observation=obs)
    got = {r["id"]: (r["is_deleted"], r["updated_at"]) for r in out.collect()}
    assert got["old"] == (True, D(2025, 1, 1))
    assert got["new"] == (False, D(2024, 12, 1))
    assert got["gone"] == (True, D(2019, 1, 1))
    assert got["never"] == (False, D(2019, 1, 1))
    assert obs.get["deleted_rows"] == 1


def test_incremental_is_strict_and_skips_late_rows(spark):
    target = spark.createDataFrame([("a", 1, D(2024, 1, 10), False)], T)
    source = spark.createDataFrame([("a", 1, D(2024, 1, 10), False), ("late", 2, D(2024, 1, 5), False),
                                    ("new", 3, D(2024, 1, 11), False)], T)
    assert rows(incremental(source, target), "id") == [("new",)]


def test_incremental_empty_target_is_first_load(spark):
    source = spark.createDataFrame([("a", 1, D(2024, 1, 10), False)], T)
    assert incremental(source, spark.createDataFrame([], T)).count() == 1
    assert incremental(source, None).count() == 1


def test_next_mark_adds_microsecond_and_keeps_old_on_empty(spark):
    old = D(2024, 1, 1)
    df = spark.createDataFrame([("a", 1, D(2024, 3, 1), False)], T)
    assert df.agg(next_mark("updated_at", old).alias("m")).first()["m"] == D(2024, 3, 1, 0, 0, 0, 1)
    assert df.where(F.lit(False)).agg(next_mark("updated_at", old).alias("m")).first()["m"] == old
    older = spark.createDataFrame([("a", 1, D(2023, 3, 1), False)], T)
    assert older.agg(next_mark("updated_at", old).alias("m")).first()["m"] == D(2024, 1, 1, 0, 0, 0, 1)
