"""Tables with a commit log: whole commits, several writers, pruned reads, key filters."""

import datetime as dt
import glob
import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dml
from tidemark.operators.files import put_if_absent, read_text
from tidemark.operators.quality import same_rows
from tidemark.operators.publish import claim_version, publish, versions
from tidemark.operators.tablelog import Conflict, LogTable

START = dt.datetime(2024, 1, 1)


def rows(spark, lo, hi, v=0, parts=4):
    return spark.range(lo, hi, 1, parts).select(
        F.format_string("k%06d", "id").alias("id"), (F.col("id") + v).cast("long").alias("v"),
        (F.lit(START.isoformat(sep=" ")).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("id") % 240).cast("int"))).alias("ts"))


def values(df):
    return {r["id"]: r["v"] for r in df.collect()}


def opened(df):
    return {os.path.relpath(p.removeprefix("file://"), "/") for p in df.inputFiles()}


def test_put_if_absent_lets_one_writer_through(spark, scratch):
    path = f"{scratch}/log/1.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: put_if_absent(spark, path, f"writer {i} " * 50), range(8)))
    assert sum(won) == 1
    assert read_text(spark, path) == f"writer {won.index(True)} " * 50
    assert [n for n in os.listdir(f"{scratch}/log") if not n.endswith(".crc")] == ["1.json"]


def test_two_writers_append_and_upsert(spark, scratch):
    t = LogTable(spark, f"{scratch}/t", key="id", buckets=8)
    t.replace(rows(spark, 0, 400))

    def work(i):
        mine = LogTable(spark, f"{scratch}/t")
        mine.upsert(rows(spark, 100 * i, 100 * i + 50, v=1000 * (i + 1)), order=None)
        mine.insert_new(rows(spark, 350, 400 + 50 * (i + 1), v=7), order=None)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(work, range(3)))
    assert t.versions() == list(range(1, 8))
    got = values(t.read())
    assert len(got) == t.read().count() == 550
    for i in range(3):
        assert all(got[f"k{k:06d}"] == k + 1000 * (i + 1) for k in range(100 * i, 100 * i + 50))
    assert got["k000549"] == 549 + 7 and got["k000399"] == 399
    assert t.latest().rows == 550


def test_reader_during_a_commit_sees_one_state(spark, scratch):
    t = LogTable(spark, f"{scratch}/t", key="id", buckets=4)
    t.replace(rows(spark, 0, 100))
    before = t.read()
    real = t.write_rows
    t.write_rows = lambda *a: (real(*a), seen.append(values(LogTable(spark, f"{scratch}/t").read())))[0]   # files are there, the commit is not
    seen = []
    t.upsert(rows(spark, 0, 100, v=500), order=None)
    assert seen == [{f"k{k:06d}": k for k in range(100)}]
    assert values(before) == seen[0]                       # a reader that began before goes on with its state
    assert values(t.read()) == {f"k{k:06d}": k + 500 for k in range(100)}
    assert values(t.read(version=1)) == seen[0]


def test_a_change_that_lost_is_done_again_on_the_new_state(spark, scratch):
    t = LogTable(spark, f"{scratch}/t", key="id", buckets=4)
    t.replace(rows(spark, 0, 10))
    other, calls = LogTable(spark, f"{scratch}/t"), []
    real = t.write_rows

    def once(*a):
        if not calls:
            calls.append(1)
            other.insert_new(rows(spark, 10, 12, v=90), order=None)
        return real(*a)

    t.write_rows = once
    assert t.insert_new(rows(spark, 8, 13, v=5), order=None).result == 1      # 10 and 11 came with the other writer
    assert values(t.read()) == {f"k{k:06d}": k if k < 10 else k + 90 if k < 12 else k + 5 for k in range(13)}
    with pytest.raises(Conflict):
        t.commit(lambda state: other.append(rows(spark, 0, 1)), tries=2)


def test_crashed_write_is_not_read_and_swept(spark, scratch):
    t = LogTable(spark, f"{scratch}/t", key="id", buckets=4)
    t.replace(rows(spark, 0, 10))
    t.write_rows(rows(spark, 50, 60))                                        # stopped before its commit
    assert t.read().count() == 10
    t.upsert(rows(spark, 0, 5, v=1), order=None)
    t.upsert(rows(spark, 0, 5, v=2), order=None)
    want = values(t.read())
    assert t.vacuum(keep=1, idle_hours=24) == 2 and len(glob.glob(f"{scratch}/t/added=*")) > 1
    t.vacuum(keep=1, idle_hours=0)
    assert values(t.read()) == want and t.versions() == [3]
    on_disk = {os.path.relpath(p, f"{scratch}/t") for p in glob.glob(f"{scratch}/t/added=*/**/*.parquet", recursive=True)}
    assert on_disk == set(t.names(t.files()))


def test_one_day_opens_the_files_of_that_day(spark, scratch):
    t = LogTable(spark, f"{scratch}/c", cluster="ts", by_day=True)
    t.append(rows(spark, 0, 2400))
    t.append(rows(spark, 2400, 4800))
    lo = START + dt.timedelta(days=3)
    day = t.between(lo, lo + dt.timedelta(days=1))
    files = {r["file"]: r for r in t.files().collect()}
    assert len(files) >= 20                                                  # ten days, two appends
    used = {n for n in files if any(p.endswith(n) for p in opened(day))}
    assert used == {n for n, r in files.items() if lo <= r["lo_ts"] < lo + dt.timedelta(days=1)}
    assert len(used) <= len(files) / 8
    assert same_rows(day, t.read().where((F.col("ts") >= F.lit(str(lo)).cast("timestamp_ntz"))
                                         & (F.col("ts") < F.lit(str(lo + dt.timedelta(days=1))).cast("timestamp_ntz"))))
    assert t.between(START - dt.timedelta(days=9), START).count() == 0 and not t.files_between(START - dt.timedelta(days=9), START)
    assert t.between().count() == 4800


def test_key_filters_never_miss_and_spare_files(spark, scratch):
    t = LogTable(spark, f"{scratch}/k", key="id", buckets=16)
    for i in range(4):                                                       # four files a bucket
        t.insert_new(rows(spark, 1000 * i, 1000 * (i + 1)), order=None)
    where = {r["id"]: r["f"] for r in t.read().select("id", F.regexp_extract(F.col("_metadata.file_path"), "(added=.*)$", 1).alias("f")).collect()}
    rng = random.Random(4)
    for _ in range(5):
        picked = rng.sample(sorted(where), 6)
        met = set(t.may_hold(spark.createDataFrame([(k,) for k in picked], "id string")))
        assert {where[k] for k in picked} <= met                             # no false negative
        assert len(met) <= 9                                                 # of 64 files
    absent = spark.range(20_000, 22_000).select(F.format_string("k%06d", "id").alias("id"))
    pairs = sum(len(t.may_hold(absent.where(F.col("id") == f"k{k:06d}"))) for k in range(20_000, 20_025))
    assert pairs <= 4                                                        # 25 keys, four files each
    change = t.upsert(rows(spark, 5, 7, v=50_000), order=None)
    assert len(change.result) <= 3 and t.read().count() == 4000
    assert values(t.read())["k000006"] == 50_006


def test_marks_come_from_the_log(spark, scratch):
    t = LogTable(spark, f"{scratch}/m", key="id", buckets=4, tracked=["ts", "v"])
    assert t.mark("ts") is None and t.read() is None
    t.replace(rows(spark, 0, 200))
    most = t.read().agg(F.max("ts"), F.max("v")).first()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("mark", "mark")
    assert (t.mark("ts"), t.mark("v")) == tuple(most)
    jobs = tracker.getJobIdsForGroup("mark")
    spark.sparkContext.setJobGroup("rest", "rest")
    assert list(jobs) == []                                                  # no job at all
    t.delete(F.col("v") > 100)
    assert t.mark("v") == 100 and t.read().count() == 101 and t.latest().rows == 101
    t.rewrite(F.col("v") == 7, lambda df: df.withColumn("v", F.when(F.col("v") == 7, 900).otherwise(F.col("v")).cast("long")))
    assert t.mark("v") == 900
    t.delete(F.col("v") >= 0)
    assert t.mark("v") is None and t.read().count() == 0


def test_changes_between_versions(spark, scratch):
    t = LogTable(spark, f"{scratch}/d", key="id", buckets=4)
    t.replace(rows(spark, 0, 40))
    v1 = t.latest().version
    t.upsert(rows(spark, 38, 42, v=100), order=None)
    t.delete(F.col("id") == "k000000")
    got = sorted((r["id"], r["v"], r["_weight"]) for r in t.changes(v1).collect())
    assert got == [("k000000", 0, -1), ("k000038", 38, -1), ("k000038", 138, 1), ("k000039", 39, -1), ("k000039", 139, 1),
                   ("k000040", 140, 1), ("k000041", 141, 1)]
    assert t.changes(t.latest().version) is None
    assert t.changes(0).count() == t.read().count()


def test_many_commits_are_merged_and_compacted(spark, scratch, monkeypatch):
    from tidemark.operators import tablelog
    monkeypatch.setattr(tablelog, "MAX_MANIFESTS", 4)
    t = LogTable(spark, f"{scratch}/n", key="id", buckets=2)
    for i in range(6):
        t.insert_new(rows(spark, 10 * i, 10 * i + 15), order=None)
    assert len(t.latest().manifests) + len(t.latest().removed) <= 4
    want = values(t.read())
    assert len(want) == 65 and t.compact(most=3) is not None
    assert values(t.read()) == want and t.latest().files == 2 and t.compact(most=3) is None
    assert t.insert_new(rows(spark, 0, 66), order=None).result == 1


def test_order_revive_and_repeated_keys(spark, scratch):
    t = LogTable(spark, f"{scratch}/o", key="id", buckets=4)
    batch = rows(spark, 0, 5).crossJoin(spark.createDataFrame([(1, 10), (2, 20)], "page int, pos int")).withColumn("v", F.col("v") + F.col("pos"))
    batch = batch.withColumn("gone", F.lit(True))
    t.upsert(batch, dml.ARRIVAL, revive="gone")
    assert values(t.read()) == {f"k{k:06d}": k + 20 for k in range(5)} and not t.read().where("gone").count()


def test_layout_is_kept(spark, scratch):
    LogTable(spark, f"{scratch}/l", key="id", buckets=4).replace(rows(spark, 0, 4))
    with pytest.raises(ValueError, match="4 buckets"):
        LogTable(spark, f"{scratch}/l", key="id", buckets=8)
    with pytest.raises(ValueError, match="layout"):
        LogTable(spark, f"{scratch}/l", cluster="ts")
    with pytest.raises(ValueError, match="not both"):
        LogTable(spark, f"{scratch}/x", key="id", cluster="ts")


def test_empty_batches(spark, scratch):
    t = LogTable(spark, f"{scratch}/e", key="id", buckets=4, tracked=["ts"])
    t.upsert(rows(spark, 0, 0), order=None)
    assert t.read().count() == 0 and t.mark("ts") is None
    t.upsert(rows(spark, 0, 3), order=None)
    assert t.insert_new(rows(spark, 0, 0), order=None).result == 0
    t.upsert(rows(spark, 0, 0), order=None)
    assert t.read().count() == 3


def test_two_publishers_take_two_versions(spark, scratch):
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda _: claim_version(spark, scratch, "p"), range(4)))
    assert sorted(got) == [1, 2, 3, 4]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda i: publish(spark.range(i + 1), scratch, "q"), range(3)))
    assert versions(spark, scratch, "q") == [1, 2, 3]
