"""Fact tables: staging rows with the surrogate keys of their dimensions.

Every join is a left join to a table unique on its key, so facts keep exactly
the staging row count.  Small dimensions arrive with a broadcast hint set
where their exact row count was known (``plans.dims``), or are sized by the
planner from their files; the customer dimension grows with the data and is
joined by the skew-safe shuffle join unless it passes the row check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rules import day, net_revenue
from tidemark.operators.joins import left_join_dim, left_join_skew_safe


def fact_payments(stg_payments: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                  dim_country: DataFrame, dim_date: DataFrame) -> DataFrame:
    f = stg_payments.select("payment_id", "customer_id", "product", "country", "amount", "fee",
                            "refunded_amount", "payment_method", "status", "updated_at",
                            day("created_at").alias("_day"))
    f = left_join_skew_safe(f, dim_customer.select("customer_id", "customer_key"), "customer_id",
                            spread_by=["payment_id"])
    f = left_join_dim(f, dim_product.select(F.col("product_name").alias("product"), "product_key"), "product",
                      check=False)
    f = left_join_dim(f, dim_country.select(F.col("country_name").alias("country"), "country_key"), "country",
                      check=False)
    f = left_join_dim(f, dim_date.select(F.col("full_date").alias("_day"), F.col("date_key").alias("order_date_key")),
                      "_day", check=False)
    return f.select("payment_id", "customer_key", "product_key", "country_key", "order_date_key",
                    net_revenue().alias("net_revenue"), "amount", "fee", "refunded_amount",
                    "payment_method", "status", "updated_at")


def fact_sessions(stg_sessions: DataFrame, dim_customer: DataFrame, dim_country: DataFrame,
                  dim_device: DataFrame, dim_campaign: DataFrame, dim_date: DataFrame) -> DataFrame:
    s = stg_sessions.select("session_id", "customer_id", "country", "device", "source", "medium", "campaign",
                            "pageviews", "session_duration_s", "bounced", "converted", "updated_at",
                            day("session_start").alias("_day"))
    # Anonymous sessions (NULL customer) never match; they bypass the shuffle.
    s = left_join_skew_safe(s, dim_customer.select("customer_id", "customer_key"), "customer_id",
                            spread_by=["session_id"])
    s = left_join_dim(s, dim_country.select(F.col("country_name").alias("country"), "country_key"), "country",
                      check=False)
    s = left_join_dim(s, dim_device.select(F.col("device_name").alias("device"), "device_key"), "device",
                      check=False)
    # Plain equality on three columns: a NULL part never matches.
    s = left_join_dim(s, dim_campaign, ["source", "medium", "campaign"], check=False)
    s = left_join_dim(s, dim_date.select(F.col("full_date").alias("_day"), F.col("date_key").alias("session_date_key")),
                      "_day", check=False)
    return s.select("session_id", "customer_key", "country_key", "device_key", "campaign_key",
                    "session_date_key", "pageviews", "session_duration_s", "bounced", "converted", "updated_at")
