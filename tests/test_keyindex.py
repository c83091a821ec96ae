"""Keys and pages from ordered ranges: equal to a rank over all members, with few ranges touched."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.reference_forms import dense_rank_key
from tidemark.operators.keyindex import KeyIndex, order_text
from tidemark.operators.quality import same_rows
from tidemark.sources import landing


def members(spark, names):
    return spark.createDataFrame([(n, len(n or "")) for n in names], "name string, size int")


def check(index, df):
    want = dense_rank_key(df, ["name"], "key")
    got = index.read("key")
    assert got.columns[0] == "key" and same_rows(got.select(*want.columns), want)


def test_equal_to_dense_rank_over_runs(spark, scratch):
    rng = random.Random(1)
    names = [f"m{rng.randrange(10**6):06d}" for _ in range(600)]
    index, have = KeyIndex(spark, f"{scratch}/i", ["name"], range_rows=50), set()
    for part in (names[:300], names[250:420], names[400:] + [None, "", "Z", "ä", "a\0b", "a"]):
        index.add(members(spark, part))
        have |= set(part)
        check(index, members(spark, sorted(have, key=repr)))
    assert index.size() == len(have)
    gone = names[::3] + ["never there"]
    index.remove(members(spark, gone))
    check(index, members(spark, sorted(have - set(gone), key=repr)))


def test_only_ranges_of_new_members_are_written(spark, scratch):
    index = KeyIndex(spark, f"{scratch}/i", ["name"], range_rows=100)
    index.add(members(spark, [f"k{i:05d}" for i in range(0, 4000, 2)]))
    index.add(members(spark, ["k00001"]))                                      # cuts the ranges that were too large
    before = {r["file"]: r["rows"] for r in index.log.files().collect()}
    assert len(before) >= 8
    assert index.add(members(spark, ["k02001", "k02003", "k02002"])) == 1      # one is there already
    after = {r["file"]: r["rows"] for r in index.log.files().collect()}
    assert len(set(before) - set(after)) == 1                                  # all other files are untouched
    assert index.add(members(spark, ["k02002"])) == 0
    want = sorted({f"k{i:05d}" for i in range(0, 4000, 2)} | {"k00001", "k02001", "k02003"})
    check(index, members(spark, want))


def test_three_columns_with_nulls(spark, scratch):
    rows = [(a, b, c) for a in ("x", None, "y") for b in ("m", None) for c in ("", "q", None)]
    random.Random(2).shuffle(rows)
    schema, cols = "source string, medium string, campaign string", ["source", "medium", "campaign"]
    index = KeyIndex(spark, f"{scratch}/c", cols, range_rows=4)
    for part in (rows[:7], rows[5:12], rows[10:]):
        index.add(spark.createDataFrame(part, schema))
    want = dense_rank_key(spark.createDataFrame(rows, schema), cols, "key")
    assert same_rows(index.read("key").select(*want.columns), want)


def test_order_text_sorts_as_the_values(spark):
    days = [dt.date(2024, 1, 9), dt.date(2023, 12, 31), None, dt.date(999, 5, 1)]
    numbers = [5, -3, None, 0, 10**12, -(10**12)]
    for values, kind in ((days, "date"), (numbers, "long")):
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        got = [r["v"] for r in df.withColumn("o", order_text(df, ["v"])).orderBy("o").collect()]
        assert got == sorted([v for v in values if v is not None]) + [None]
    with pytest.raises(ValueError, match="order text"):
        order_text(spark.createDataFrame([(1.5,)], "v double"), ["v"])


def test_first_and_last_page_open_one_range_each(spark, scratch):
    rows = spark.range(0, 5000).select(F.format_string("p%06d", (F.col("id") * 7919) % 5000).alias("payment_id"), "id")
    index = KeyIndex(spark, f"{scratch}/p", ["payment_id"], range_rows=200)
    index.add(rows.where("id % 5 <> 0"))
    index.add(rows)
    assert index.log.latest().files >= 10
    last = 50
    for page in (1, 2, 17, last):
        got, want = index.page(page, 100), landing.page_slice(rows, "payment_id", page, 100)
        assert same_rows(got.select(*want.columns), want) and got.count() == 100
        assert len(got.inputFiles()) <= (1 if page in (1, last) else 2), page
    assert index.page(last + 1, 100).count() == 0


def test_empty(spark, scratch):
    index = KeyIndex(spark, f"{scratch}/e", ["name"])
    assert index.read("key") is None and index.size() == 0 and index.remove(members(spark, ["a"])) == 0
    index.add(members(spark, ["b"]).limit(0))
    assert index.size() == 0
    index.add(members(spark, ["b", "a"]))
    check(index, members(spark, ["a", "b"]))
