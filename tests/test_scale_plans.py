"""Plan shape checks for the scale-sensitive operators."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dml
from tidemark.operators.joins import left_join_skew_safe
from tidemark.operators.quality import same_rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_null_split_join_is_one_pass_and_exact(spark):
    # 2/3 of the fact rows have a NULL key; the dimension is over the bound.
    fact = spark.range(30000).select(
        F.col("id").alias("fid"),
        F.when(F.col("id") % 3 == 0, F.format_string("c%04d", F.col("id") % 1000)).alias("customer_id"))
    dim = spark.range(1000).select(F.format_string("c%04d", "id").alias("customer_id"), (F.col("id") + 1).alias("ck"))
    got = left_join_skew_safe(fact, dim, "customer_id", max_bytes=0)
    want = fact.join(dim, "customer_id", "left")
    assert same_rows(got.select(*want.columns), want)
    p = plan(got)
    assert "Union" not in p and "SinglePartition" not in p


def test_null_keys_spread_over_partitions(spark):
    fact = spark.range(20000).select(F.col("id").alias("fid"), F.lit(None).cast("string").alias("customer_id"))
    dim = spark.range(100).select(F.format_string("c%04d", "id").alias("customer_id"), F.col("id").alias("ck"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = left_join_skew_safe(fact, dim, "customer_id", max_bytes=0)
        sizes = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1
    assert max(r["count"] for r in sizes) < 20000 / 2


def test_hot_key_dedup_combines_before_shuffle(spark):
    # One key holds a third of the batch.
    batch = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("k%05d", "id")).alias("id"),
        F.col("id").cast("int").alias("v"), (F.col("id") / 500).cast("int").alias("page"),
        (F.col("id") % 500).cast("int").alias("pos"))
    out = dml.last_in_batch(batch, "id")
    p = plan(out)
    assert "partial_max_by" in p      # map-side combine before the exchange
    hot = out.where(F.col("id") == "hot").first()
    assert hot["v"] == 29997           # the last arrival of the hot key
    assert out.count() == 20001


@pytest.mark.parametrize("percent", [0.5, 35])
def test_hot_key_is_salted_by_its_size_and_exact(spark, percent):
    from tidemark.operators.joins import hot_keys
    # one customer holds a share of the fact rows; a third of the rest are NULL
    n, hot = 200_000, int(2000 * percent)
    fact = spark.range(n).select(
        F.col("id").alias("fid"),
        F.when(F.col("id") < hot, F.lit("c0007"))
         .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
         .otherwise(F.format_string("c%05d", F.col("id") % 50_000)).alias("customer_id"))
    dim = spark.range(50_000).select(F.format_string("c%05d", "id").alias("customer_id"), (F.col("id") + 1).alias("ck"))
    dim = dim.unionByName(spark.createDataFrame([("c0007", 0)], "customer_id string, ck long"))
    target = 250
    salts = {r["customer_id"]: r["_salts"] for r in hot_keys(fact, "customer_id", target, 1.0).collect()}
    assert salts == {"c0007": -(-hot // target)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = left_join_skew_safe(fact, dim, "customer_id", max_bytes=0, rows_per_task=target, fraction=1.0)
        assert "SinglePartition" not in plan(got)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    want = fact.join(dim, "customer_id", "left")
    assert same_rows(got.select(*want.columns), want)
    assert max(sizes) < 2 * n / 64          # neither the hot key nor NULLs sit in one task
