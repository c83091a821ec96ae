"""Explicit schemas: never infer a landed or raw table."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)
TS = T.TimestampNTZType()   # UTC wall-clock time everywhere

# Landed JSON entities as the list service sends them (ISO strings for times).
CUSTOMER_JSON = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("company_size", T.StringType()),
    T.StructField("signup_date", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("is_churned", T.BooleanType()),
    T.StructField("last_seen_at", T.StringType()),
])
PAYMENT_JSON = T.StructType([
    T.StructField("payment_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("refunded_amount", T.DoubleType()),
    T.StructField("fee", T.DoubleType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
])
SESSION_JSON = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("medium", T.StringType()),
    T.StructField("campaign", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("pageviews", T.IntegerType()),
    T.StructField("session_duration_s", T.IntegerType()),
    T.StructField("bounced", T.IntegerType()),
    T.StructField("converted", T.IntegerType()),
    T.StructField("session_start", T.StringType()),
    T.StructField("updated_at", T.StringType()),
])
ENTITY_JSON = {"customers": CUSTOMER_JSON, "payments": PAYMENT_JSON, "sessions": SESSION_JSON}


def envelope(entity: str) -> T.StructType:
    """One page of the list service: totals plus the page's rows."""
    return T.StructType([
        T.StructField("page", T.IntegerType()),
        T.StructField("page_size", T.IntegerType()),
        T.StructField("total_pages", T.IntegerType()),
        T.StructField("next_page", T.IntegerType()),
        T.StructField("count", T.IntegerType()),
        T.StructField("data", T.ArrayType(ENTITY_JSON[entity])),
    ])


# Lineage columns added on landing.
LINEAGE = [
    T.StructField("ingestion_ts", T.StringType()),
    T.StructField("source_endpoint", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("landed", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("ingestion_date", T.DateType()),
]


def bronze(entity: str) -> T.StructType:
    return T.StructType(list(ENTITY_JSON[entity].fields) + LINEAGE)


# Typed raw tables (primary key first).
RAW_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("company_size", T.StringType()),
    T.StructField("signup_date", TS),
    T.StructField("updated_at", TS),
    T.StructField("is_churned", T.BooleanType()),
    T.StructField("last_seen_at", TS),
    T.StructField("is_deleted", T.BooleanType()),
])
RAW_PAYMENTS = T.StructType([
    T.StructField("payment_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("refunded_amount", MONEY),
    T.StructField("fee", MONEY),
    T.StructField("payment_method", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("created_at", TS),
    T.StructField("updated_at", TS),
])
RAW_SESSIONS = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("medium", T.StringType()),
    T.StructField("campaign", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("pageviews", T.IntegerType()),
    T.StructField("session_duration_s", T.IntegerType()),
    T.StructField("bounced", T.IntegerType()),
    T.StructField("converted", T.IntegerType()),
    T.StructField("session_start", TS),
    T.StructField("updated_at", TS),
])
RAW = {"customers": RAW_CUSTOMERS, "payments": RAW_PAYMENTS, "sessions": RAW_SESSIONS}
KEYS = {"customers": "customer_id", "payments": "payment_id", "sessions": "session_id"}


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to ``schema`` by name (missing columns -> NULL)."""
    from pyspark.sql import functions as F
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
