"""Gold aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import MONEY_SUM


def agg_payments_daily(fact_payments: DataFrame) -> DataFrame:
    """Per day, product and country.  The one distinct count is planned as a
    two-level aggregate (keys + customer_key, then keys), so a hot group is
    spread over its customers and partially aggregated before each shuffle."""
    return (fact_payments.groupBy("order_date_key", "product_key", "country_key")
            .agg(F.sum("net_revenue").cast(MONEY_SUM).alias("total_net_revenue"),
                 F.sum("amount").cast(MONEY_SUM).alias("total_amount"),
                 F.count("payment_id").alias("total_orders"),
                 F.countDistinct("customer_key").alias("active_customers")))


def agg_sessions_daily(fact_sessions: DataFrame) -> DataFrame:
    """Per day, device and country.

    The fact keys are grouped directly: a left join of a fact key back to its
    own dimension returns the same key (every non-NULL key came from that
    dimension).  ``session_id`` is the fact's unique key, so its distinct
    count is a plain count: one shuffle with partial aggregation.
    """
    return (fact_sessions.groupBy("session_date_key", "device_key", "country_key")
            .agg(F.count("session_id").alias("total_sessions"),
                 F.sum("pageviews").cast("bigint").alias("total_pageviews"),
                 F.avg("session_duration_s").alias("avg_session_duration_s"),
                 F.avg(F.col("bounced").cast("int")).alias("bounce_rate"),
                 F.avg(F.col("converted").cast("int")).alias("conversion_rate")))


def customer_activity(stg_payments: DataFrame, stg_sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-customer payment and session totals, aggregated before any join.

    Staging is unique on payment_id and session_id, so the distinct counts are
    plain counts; anonymous sessions are dropped before the shuffle.
    """
    pay = (stg_payments.where(F.col("customer_id").isNotNull())
           .groupBy("customer_id")
           .agg(F.count("payment_id").alias("_orders"), F.sum("net_revenue").alias("_revenue")))
    ses = (stg_sessions.where(F.col("customer_id").isNotNull())
           .groupBy("customer_id")
           .agg(F.max("session_start").alias("last_session"), F.count("session_id").alias("_sessions")))
    return pay, ses


def agg_customer_summary(dim_customer: DataFrame, stg_payments: DataFrame, stg_sessions: DataFrame,
                         fanout: bool = False) -> DataFrame:
    """Orders, revenue, last session and sessions per customer.

    ``fanout=True`` reproduces the revenue of joining customer x payments x
    sessions before the sum: each payment then counts once per session (at
    least once).  It is computed from the per-customer totals, never by
    emitting the pairs.
    """
    pay, ses = customer_activity(stg_payments, stg_sessions)
    j = (dim_customer.select("customer_key", "customer_id", "country", "industry", "company_size",
                             "signup_date", "is_churned")
         .join(pay, "customer_id", "left")
         .join(ses, "customer_id", "left"))
    revenue = F.col("_revenue")
    if fanout:
        revenue = revenue * F.greatest(F.col("_sessions"), F.lit(1))
    return j.select("customer_key", "country", "industry", "company_size",
                    F.coalesce("_orders", F.lit(0)).cast("bigint").alias("total_orders"),
                    revenue.cast(MONEY_SUM).alias("total_revenue"),
                    "last_session",
                    F.coalesce("_sessions", F.lit(0)).cast("bigint").alias("total_sessions"),
                    "signup_date", "is_churned")
