"""dense_key equals dense_rank without a single-task window."""

import random

from pyspark.sql import functions as F

from tests.reference_forms import dense_rank_key
from tidemark.operators.keys import dense_key


def _same(a, b, key):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(*a.columns).collect()), key=repr)


def test_single_key_many_partitions(spark):
    df = spark.range(1000).select(F.format_string("k%05d", (F.col("id") * 7919) % 1000).alias("k")).repartition(4)
    assert _same(dense_key(df, ["k"], "key"), dense_rank_key(df, ["k"], "key"), "key")


def test_three_columns_with_nulls(spark):
    rnd = random.Random(7)
    vals = {(rnd.choice([None, "a", "b", "c"]), rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, "x", "y"]))
            for _ in range(400)}
    df = spark.createDataFrame(sorted(vals, key=repr), "s string, m int, c string").repartition(8)
    got = dense_key(df, ["s", "m", "c"], "key", num_partitions=8)
    assert _same(got, dense_rank_key(df, ["s", "m", "c"], "key"), "key")


def test_keys_are_one_to_n(spark):
    df = spark.range(5000).select((F.col("id") * 3).alias("v"))
    got = dense_key(df, ["v"], "key").agg(F.min("key"), F.max("key"), F.countDistinct("key")).first()
    assert tuple(got) == (1, 5000, 5000)


def test_empty_input(spark):
    df = spark.createDataFrame([], "v string")
    assert dense_key(df, ["v"], "key").count() == 0


def test_ranks_spread_over_partitions(spark):
    """The ranked rows come from several range partitions, not one task."""
    df = spark.range(20000).select(F.col("id").alias("v"))
    out = dense_key(df, ["v"], "key", num_partitions=8)
    parts = out.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1
    assert out.agg(F.max("key")).first()[0] == 20000


def test_many_partitions_use_offset_table(spark):
    df = spark.range(30000).select(F.format_string("k%06d", (F.col("id") * 7919) % 30000).alias("k"))
    got = dense_key(df, ["k"], "key", num_partitions=300)
    r = got.agg(F.min("key"), F.max("key"), F.countDistinct("key")).first()
    assert tuple(r) == (1, 30000, 30000)
    assert got.where(F.col("k") == "k000123").first()["key"] == 124


def test_default_range_count_follows_the_session(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20000).select(F.col("id").alias("v"))
        out = dense_key(df, ["v"], "key")
        parts = out.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1
    assert out.agg(F.max("key")).first()[0] == 20000
