"""Staging models: typed, cleaned copies of the raw tables (narrow plans)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rules import day, month_start, net_revenue
from tidemark.schemas import TS

STG_KEYS = {"stg_customers": "customer_id", "stg_payments": "payment_id", "stg_sessions": "session_id"}


def stg_customers(raw: DataFrame) -> DataFrame:
    """Live customers only (``is_deleted = false``; NULL is dropped too)."""
    return (raw.where(F.col("is_deleted") == F.lit(False))
               .select("customer_id", "company_name", "country", "industry", "company_size",
                       F.col("signup_date").cast(TS).alias("signup_date"),
                       F.col("updated_at").cast(TS).alias("updated_at"),
                       F.col("is_churned").cast("boolean").alias("is_churned"),
                       month_start("signup_date").alias("signup_month")))


def stg_payments(raw: DataFrame) -> DataFrame:
    return raw.select("payment_id", "customer_id", "product", "amount", "currency", "status",
                      "refunded_amount", "fee", "payment_method", "country",
                      F.col("created_at").cast(TS).alias("created_at"),
                      F.col("updated_at").cast(TS).alias("updated_at"),
                      net_revenue().alias("net_revenue"),
                      day("created_at").alias("order_day"))


def stg_sessions(raw: DataFrame) -> DataFrame:
    return raw.select("session_id",
                      F.nullif(F.col("customer_id").cast("string"), F.lit("")).alias("customer_id"),
                      F.lower("source").alias("source"),
                      F.lower("medium").alias("medium"),
                      "campaign",
                      F.lower("device").alias("device"),
                      "country", "pageviews", "session_duration_s",
                      (F.col("bounced") == 1).alias("bounced"),
                      (F.col("converted") == 1).alias("converted"),
                      F.col("session_start").cast(TS).alias("session_start"),
                      F.col("updated_at").cast(TS).alias("updated_at"),
                      day("session_start").alias("session_day"))


STAGING = {"customers": stg_customers, "payments": stg_payments, "sessions": stg_sessions}
