"""Layer databases, typed empty tables, versions and schema routing."""

from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.operators.publish import (current, ensure_layers, ensure_table, publish, qualified, register,
                                        retain, table_exists, versions)
from tidemark.schemas import RAW_PAYMENTS


def test_ensure_table_then_publish_versions(spark, scratch):
    root = f"{scratch}/raw"
    assert not table_exists(spark, root, "payments")
    ensure_table(spark, root, "payments", RAW_PAYMENTS)
    assert table_exists(spark, root, "payments")
    assert current(spark, root, "payments").schema == RAW_PAYMENTS
    ensure_table(spark, root, "payments", RAW_PAYMENTS)          # no second version
    assert versions(spark, root, "payments") == [1]
    publish(spark.range(3), root, "payments")
    assert versions(spark, root, "payments") == [1, 2]
    assert current(spark, root, "payments").count() == 3


def test_half_written_version_is_not_read(spark, scratch):
    root = f"{scratch}/gold"
    publish(spark.range(2), root, "t")
    spark.range(5).write.parquet(f"{root}/t/v=000002")
    import os
    os.remove(f"{root}/t/v=000002/_SUCCESS")
    assert current(spark, root, "t").count() == 2
    # the next publish after the crashed attempt gets a fresh number
    publish(spark.range(7), root, "t")
    assert versions(spark, root, "t") == [1, 3]
    assert current(spark, root, "t").count() == 7


def test_register_points_catalog_at_current(spark, scratch):
    ensure_layers(spark, scratch, ["gold"])
    publish(spark.range(4), f"{scratch}/gold", "dim_x")
    register(spark, scratch, "gold", "dim_x")
    assert spark.table("gold.dim_x").count() == 4
    publish(spark.range(6), f"{scratch}/gold", "dim_x")
    register(spark, scratch, "gold", "dim_x")
    assert spark.table("gold.dim_x").count() == 6


def test_schema_routing():
    assert qualified("dim_customer", "gold", "public") == "gold.dim_customer"
    assert qualified("stg", None, "public") == "public.stg"


def test_clustered_publish_sorts_inside_files(spark, scratch):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("t")).coalesce(1)
    path = publish(df, scratch, "c", cluster_by="t")
    vals = [r["t"] for r in spark.read.parquet(path).collect()]
    assert vals == sorted(vals)


def test_list_amount_and_company_name(spark):
    r = spark.createDataFrame([("Pro", 3, "3f2a9c1d-aaaa")], "product string, seats int, id string").select(
        rules.list_amount(F.lit(rules.PRICES["Pro"]), "seats").alias("a"),
        rules.company_name_from_id("id").alias("n")).first()
    assert str(r["a"]) == "297.00" and r["n"] == "Company 3f2a9c1d"


def test_retain_keeps_the_last_versions(spark, scratch):
    root = f"{scratch}/g"
    for i in range(4):
        publish(spark.range(i + 1), root, "t")
    assert retain(spark, root, "t", keep=2) == [1, 2]
    assert versions(spark, root, "t") == [3, 4]
    assert current(spark, root, "t").count() == 4
    assert retain(spark, root, "t", keep=2) == []


def test_retain_drops_old_crashed_attempts_only(spark, scratch):
    import os
    root = f"{scratch}/h"
    publish(spark.range(1), root, "t")                       # v1
    spark.range(2).write.parquet(f"{root}/t/v=000002")         # v2 crashed
    os.remove(f"{root}/t/v=000002/_SUCCESS")
    publish(spark.range(3), root, "t")                       # v3
    publish(spark.range(4), root, "t")                       # v4
    spark.range(5).write.parquet(f"{root}/t/v=000005")         # v5 crashed, newer: kept
    os.remove(f"{root}/t/v=000005/_SUCCESS")
    assert retain(spark, root, "t", keep=2) == [1, 2]
    assert versions(spark, root, "t", finished=False) == [3, 4, 5]
    assert current(spark, root, "t").count() == 4
