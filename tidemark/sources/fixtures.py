"""Raw customers, payments and sessions derived from the input tables.

The mapping (FIXTURES.md section 3) turns the TPC-H-like tables into the three
typed raw tables of the subscription pipeline.  Every table grows with the
input: customers with ``customer``, payments with ``orders`` (products from
``lineitem`` x ``part``), sessions with ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rules import money
from tidemark.schemas import RAW_CUSTOMERS, RAW_PAYMENTS, RAW_SESSIONS, TS, conform
from tidemark.session import configure
from tidemark.sources.tables import read_table

# Fixed values of the fixture mapping.
DEFAULT_TIME = "1995-01-01 00:00:00"
SIZE_BY_MOD5 = ["1-10", "11-50", "51-200", "201-500", "500+"]
EUR_REGION = 3
DELETED_MOD = 97
MEDIUM_BY_MOD6 = ["Organic", "CPC", "Email", "social", "none", "referral"]


def pad_id(c) -> F.Column:
    return F.lpad(F.col(c).cast("string"), 10, "0")


def _case(expr, values):
    out = None
    for i, v in enumerate(values[:-1]):
        out = (F.when(expr == i, v) if out is None else out.when(expr == i, v))
    return out.otherwise(values[-1])


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    # Partial aggregation per customer before the shuffle.
    span = (read_table(spark, sf_dir, "orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")))
    default = F.lit(DEFAULT_TIME).cast(TS)
    # Input tables carry file sizes: the planner broadcasts small ones itself.
    df = (cust.join(nation, "c_nationkey")
              .join(span, "c_custkey", "left")
              .select(pad_id("c_custkey").alias("customer_id"),
                      F.col("c_name").alias("company_name"),
                      F.col("n_name").alias("country"),
                      F.col("c_mktsegment").alias("industry"),
                      _case(F.col("c_custkey") % 5, SIZE_BY_MOD5).alias("company_size"),
                      F.coalesce("lo", default).alias("signup_date"),
                      F.coalesce("hi", default).alias("updated_at"),
                      (F.col("c_acctbal") < 0).alias("is_churned"),
                      F.coalesce("hi", default).alias("last_seen_at"),
                      (F.col("c_custkey") % DELETED_MOD == 0).alias("is_deleted")))
    return conform(df, RAW_CUSTOMERS)


def order_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per order: the smallest part type among its lines (combined before the shuffle)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (li.join(part, "p_partkey")
              .groupBy(F.col("l_orderkey").alias("o_orderkey"))
              .agg(F.min("p_type").alias("product")))


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    amount = money("o_totalprice")
    status = (F.when(F.col("o_orderstatus") == "F", "succeeded")
               .when(F.col("o_orderstatus") == "O", "failed").otherwise("refunded"))
    refund = F.when(F.col("o_orderstatus") == "P", F.round(amount * F.lit("0.25").cast("decimal(3,2)"), 2).cast(RAW_PAYMENTS["amount"].dataType))
    fee = F.when(F.col("o_orderkey") % 10 != 0,
                 F.round(amount * F.lit("0.029").cast("decimal(4,3)") + F.lit("0.30").cast("decimal(3,2)"), 2)
                  .cast(RAW_PAYMENTS["amount"].dataType))
    df = (orders.join(cust, "o_custkey")
                .join(nation, "c_nationkey")
                .join(order_products(spark, sf_dir), "o_orderkey", "left")
                .select(pad_id("o_orderkey").alias("payment_id"),
                        pad_id("o_custkey").alias("customer_id"),
                        F.col("product"),
                        amount.alias("amount"),
                        F.when(F.col("n_regionkey") == EUR_REGION, "EUR").otherwise("USD").alias("currency"),
                        status.alias("status"),
                        refund.alias("refunded_amount"),
                        fee.alias("fee"),
                        F.lower("o_orderpriority").alias("payment_method"),
                        F.col("n_name").alias("country"),
                        F.col("o_orderdate").alias("created_at"),
                        F.col("o_orderdate").alias("updated_at")))
    return conform(df, RAW_PAYMENTS)


def raw_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow: one projection over ``events``, no shuffle."""
    configure(spark)
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.regexp_extract("props", r"([0-9]+)", 1).cast("int")
    ev = ev.withColumn("k", k)
    k = F.col("k")
    pageviews = (F.lit(1) + F.col("event_id") % 7).cast("int")
    duration = F.floor("value").cast("int")
    medium = _case(k % 6, MEDIUM_BY_MOD6)
    campaign = (F.when(k == 97, F.lit(None).cast("string"))
                 .when((k % 6).isin(0, 4, 5), "").otherwise("product_launch"))
    device = (F.when(k == 99, F.lit(None).cast("string"))
               .when(k % 20 < 11, "Desktop").when(k % 20 < 19, "mobile").otherwise("Tablet"))
    country = F.when(k == 98, F.lit(None).cast("string")).otherwise(F.concat(F.lit("NATION_"), (k % 25).cast("string")))
    df = ev.select(
        pad_id("event_id").alias("session_id"),
        F.when(k % 3 == 0, pad_id("user_id")).otherwise("").alias("customer_id"),
        F.upper("event_type").alias("source"),
        medium.alias("medium"),
        campaign.alias("campaign"),
        device.alias("device"),
        country.alias("country"),
        pageviews.alias("pageviews"),
        duration.alias("session_duration_s"),
        F.when((pageviews == 1) & (duration < 10), 1).otherwise(0).alias("bounced"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("converted"),
        F.col("ts").alias("session_start"),
        F.col("ts").alias("updated_at"))
    return conform(df, RAW_SESSIONS)


RAW_BUILDERS = {"customers": raw_customers, "payments": raw_payments, "sessions": raw_sessions}
