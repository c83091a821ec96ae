"""Gold dimensions with dense surrogate keys (1..n in key order, NULLs last).

Staging already lower-cases source, medium and device, so the dimensions do
not lower them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rules import day_of_week
from tidemark.operators.joins import maybe_broadcast
from tidemark.operators.keys import dense_key as operators_dense_key

# Member sets read from one table in a single grouping-sets pass.
SESSION_SETS = {"country": ["country"], "date": ["session_day"], "device": ["device"],
                "campaign": ["source", "medium", "campaign"]}
PAYMENT_SETS = {"product": ["product"], "country": ["country"], "date": ["order_day"]}


def dense_key(df: DataFrame, order_cols: list[str], key: str) -> DataFrame:
    """``operators.keys.dense_key`` for a dimension; one within the broadcast
    bound carries the broadcast hint from here on (joins need no second size check)."""
    return maybe_broadcast(operators_dense_key(df, order_cols, key))


def _columns(sets: dict) -> list[str]:
    out: list[str] = []
    for cols in sets.values():
        out += [c for c in cols if c not in out]
    return out


def members(df: DataFrame, sets: dict, aggs: list | None = None) -> DataFrame:
    """Distinct members of several dimensions in one pass over ``df``.

    ``GROUPING SETS`` reads the table once and shuffles only the partially
    aggregated members; ``_gid`` (grouping_id) tells the sets apart, so a NULL
    member is not confused with a column grouped away.
    """
    cols = _columns(sets)
    return (df.groupingSets([[F.col(c) for c in s] for s in sets.values()], *[F.col(c) for c in cols])
              .agg(F.grouping_id().alias("_gid"), *(aggs or [])))


def member_set(all_members: DataFrame, sets: dict, name: str, with_aggs: bool = False) -> DataFrame:
    """The rows of one set: its columns (and the aggregates when asked)."""
    cols = _columns(sets)
    wanted = sets[name]
    gid = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in wanted)
    aggs = [c for c in all_members.columns if c not in cols and c != "_gid"] if with_aggs else []
    return all_members.where(F.col("_gid") == gid).select(*wanted, *aggs)


def session_members(stg_sessions: DataFrame) -> DataFrame:
    return members(stg_sessions, SESSION_SETS)


def payment_members(stg_payments: DataFrame) -> DataFrame:
    """Product set carries first and last change; the other sets ignore them."""
    return members(stg_payments, PAYMENT_SETS,
                   [F.min("updated_at").alias("created_at"), F.max("updated_at").alias("updated_at")])


def dim_country(stg_customers: DataFrame, stg_payments: DataFrame, stg_sessions: DataFrame,
                pay_members: DataFrame | None = None, ses_members: DataFrame | None = None) -> DataFrame:
    p = member_set(pay_members, PAYMENT_SETS, "country") if pay_members is not None else stg_payments.select("country")
    s = member_set(ses_members, SESSION_SETS, "country") if ses_members is not None else stg_sessions.select("country")
    countries = (stg_customers.select("country").union(p).union(s)
                 .where(F.col("country").isNotNull())
                 .distinct())
    return dense_key(countries, ["country"], "country_key").select(
        "country_key", F.col("country").alias("country_name"))


def dim_customer(stg_customers: DataFrame) -> DataFrame:
    """One row per customer: staging is keyed (merged) on customer_id, so the
    rows are already distinct and unique on the order column."""
    rows = stg_customers.where(F.col("customer_id").isNotNull()).select(
        "customer_id", "company_name", "country", "industry", "company_size",
        "signup_date", "updated_at", "is_churned")
    return dense_key(rows, ["customer_id"], "customer_key")


def dim_date(stg_payments: DataFrame, stg_sessions: DataFrame,
             pay_members: DataFrame | None = None, ses_members: DataFrame | None = None) -> DataFrame:
    """Dates seen in payments or sessions (no gap fill)."""
    p = (member_set(pay_members, PAYMENT_SETS, "date") if pay_members is not None
         else stg_payments.select("order_day"))
    s = (member_set(ses_members, SESSION_SETS, "date") if ses_members is not None
         else stg_sessions.select("session_day"))
    dates = (p.select(F.col("order_day").alias("full_date"))
             .union(s.select(F.col("session_day").alias("full_date")))
             .distinct())
    return dense_key(dates, ["full_date"], "date_key").select(
        "date_key", "full_date",
        F.year("full_date").cast("int").alias("year"),
        F.month("full_date").cast("int").alias("month"),
        F.dayofmonth("full_date").cast("int").alias("day"),
        day_of_week("full_date").alias("day_of_week"))


def dim_device(stg_sessions: DataFrame, ses_members: DataFrame | None = None) -> DataFrame:
    source = (member_set(ses_members, SESSION_SETS, "device") if ses_members is not None
              else stg_sessions.select("device"))
    devices = source.where(F.col("device").isNotNull()).distinct()
    return dense_key(devices, ["device"], "device_key").select(
        "device_key", F.col("device").alias("device_name"))


def dim_product(stg_payments: DataFrame, pay_members: DataFrame | None = None) -> DataFrame:
    """First and last change seen per product."""
    if pay_members is not None:
        products = member_set(pay_members, PAYMENT_SETS, "product", with_aggs=True).where(F.col("product").isNotNull())
    else:
        products = (stg_payments.where(F.col("product").isNotNull())
                    .groupBy("product")
                    .agg(F.min("updated_at").alias("created_at"), F.max("updated_at").alias("updated_at")))
    return dense_key(products, ["product"], "product_key").select(
        "product_key", F.col("product").alias("product_name"), "created_at", "updated_at")


def dim_campaign(stg_sessions: DataFrame, ses_members: DataFrame | None = None) -> DataFrame:
    """Distinct (source, medium, campaign); NULL parts are kept and sort last."""
    campaigns = (member_set(ses_members, SESSION_SETS, "campaign") if ses_members is not None
                 else stg_sessions.select("source", "medium", "campaign").distinct())
    return dense_key(campaigns, ["source", "medium", "campaign"], "campaign_key")
