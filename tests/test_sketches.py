"""Customer sketches: within the error bound, and merged equal to built at once."""

from pyspark.sql import functions as F

from tidemark.plans.sketches import STANDARD_ERROR, customer_sketches, estimated, merged


def payments(spark, n=60_000):
    return spark.range(n).select(F.expr("date_add(date'2024-01-01', cast(id % 90 as int))").alias("order_day"),
                                 F.when(F.col("id") % 11 != 0, F.concat(F.lit("c"), (F.col("id") * 7919 % 23_000).cast("string"))).alias("customer_id"),
                                 F.when(F.col("id") % 3 != 0, F.lit("A")).alias("product"))


def test_within_the_error_bound(spark):
    p = payments(spark)
    exact = {r["product"]: r["n"] for r in p.groupBy("product").agg(F.countDistinct("customer_id").alias("n")).collect()}
    for r in estimated(customer_sketches(p, ["product"])).collect():
        assert abs(r["active_customers"] - exact[r["product"]]) <= 5 * STANDARD_ERROR * exact[r["product"]]


def test_merged_equals_built_at_once(spark):
    p = payments(spark)
    days = customer_sketches(p, ["order_day", "product"])
    month = F.trunc("order_day", "month").alias("month")
    a = {(r["month"], r["product"]): r["active_customers"] for r in estimated(merged(days, [month, "product"])).collect()}
    b = {(r["month"], r["product"]): r["active_customers"] for r in estimated(customer_sketches(p.withColumn("month", month), ["month", "product"])).collect()}
    assert a == b and len(a) == 6


def test_null_customers_and_empty_input(spark):
    p = payments(spark, 100).withColumn("customer_id", F.lit(None).cast("string"))
    assert {r["active_customers"] for r in estimated(customer_sketches(p, ["product"])).collect()} == {0}
    assert estimated(merged(customer_sketches(p.limit(0), ["product"]), ["product"])).collect() == []
