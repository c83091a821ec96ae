"""In-place upserts equal the full-rewrite forms."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import dml
from tidemark.operators.inplace import append_new, read_bucketed, upsert_buckets
from tidemark.operators.quality import same_rows

B = "id string, v int, updated_at timestamp_ntz, page int, pos int"
D = dt.datetime


def test_upsert_buckets_rewrites_only_touched(spark, scratch):
    path = f"{scratch}/t"
    first = spark.range(2000).select(F.format_string("k%05d", "id").alias("id"), F.col("id").cast("int").alias("v"),
                                     F.lit(D(2024, 1, 1)).cast("timestamp_ntz").alias("updated_at"),
                                     F.lit(1).alias("page"), F.col("id").cast("int").alias("pos"))
    upsert_buckets(spark, path, first, "id", buckets=64)
    batch = spark.createDataFrame([("k00001", 10, D(2024, 2, 1), 1, 0), ("k00001", 11, D(2024, 2, 2), 1, 1),
                                   ("new", 5, D(2024, 2, 1), 1, 2)], B)
    touched = upsert_buckets(spark, path, batch, "id", buckets=64)
    assert len(touched) <= 2
    got = read_bucketed(spark, path)
    want = dml.upsert(first.drop("page", "pos"), batch, "id")
    assert same_rows(got.select(*want.columns), want)


def test_append_new_keeps_existing_rows(spark, scratch):
    path = f"{scratch}/s"
    first = spark.createDataFrame([("a", 1, D(2024, 1, 1), 1, 0)], B)
    assert append_new(spark, path, first, "id") == 1
    batch = spark.createDataFrame([("a", 9, D(2024, 3, 1), 1, 0), ("b", 2, D(2024, 3, 1), 1, 1),
                                   ("b", 3, D(2024, 3, 2), 2, 0)], B)
    assert append_new(spark, path, batch, "id") == 1
    got = sorted((r["id"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1), ("b", 2)]


def test_one_file_per_bucket(spark, scratch):
    import glob
    path = f"{scratch}/f"
    rows = spark.range(5000).select(F.format_string("k%05d", "id").alias("id"), F.col("id").cast("int").alias("v"),
                                    F.lit(D(2024, 1, 1)).cast("timestamp_ntz").alias("updated_at"),
                                    F.lit(1).alias("page"), F.col("id").cast("int").alias("pos")).repartition(8)
    upsert_buckets(spark, path, rows, "id", buckets=16)
    upsert_buckets(spark, path, rows.limit(100), "id", buckets=16)
    for folder in glob.glob(f"{path}/_bucket=*"):
        assert len(glob.glob(f"{folder}/*.parquet")) == 1
    assert read_bucketed(spark, path).count() == 5000
