"""Business rules as column expressions (all JVM-side, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import MONEY, TS

# ---------------------------------------------------------------------------
# These must equal the source system's value sets.
PRODUCTS = ["Basic", "Pro", "Enterprise", "Addon-Analytics", "Addon-Support"]
PRICES = {"Basic": 29, "Pro": 99, "Enterprise": 499, "Addon-Analytics": 49, "Addon-Support": 99}
EUR_COUNTRIES = ["DE", "FR", "NL", "PT", "IT", "ES"]
BLANK_CAMPAIGN_MEDIUMS = ["organic", "none", "referral"]
CAMPAIGN_NAME = "product_launch"
FEE_RATE = "0.029"
FEE_FIXED = "0.30"
BASE_CONVERSION = "0.02"
CONVERSION_BONUS = {"cpc": "0.02", "email": "0.03", "desktop": "0.01", "pageviews>=3": "0.01"}
BOUNCE_MAX_SECONDS = 10
STALE_DAYS = 360
PAGE_SIZE_DEFAULT = 500
PAGE_SIZE_MAX = 1000
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    return _c(x).cast(MONEY)


def net_revenue(amount="amount", fee="fee", refunded="refunded_amount") -> Column:
    """amount - fee - refund, a missing fee or refund counting as zero."""
    return (_c(amount) - F.coalesce(_c(fee), F.lit(0)) - F.coalesce(_c(refunded), F.lit(0))).cast(MONEY)


def day(ts) -> Column:
    return _c(ts).cast("date")


def month_start(ts) -> Column:
    return F.date_trunc("month", _c(ts)).cast("date")


def day_of_week(d) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return (F.dayofweek(_c(d)) - 1).cast("int")


def iso_to_ts(s) -> Column:
    """ISO-8601 text (with or without offset) -> UTC wall-clock timestamp.

    Empty text counts as missing (NULL); malformed text fails the job under
    ANSI mode, as a bad timestamp does at the source.
    """
    return F.to_timestamp(F.nullif(_c(s), F.lit(""))).cast(TS)


def ts_to_iso(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def list_amount(list_price="list_price", seats="seats") -> Column:
    """amount = list price x seats (money)."""
    return (_c(list_price).cast(MONEY) * _c(seats)).cast(MONEY)


def fee(amount="amount") -> Column:
    """Card fee: round(amount * 2.9 % + 0.30, 2), half up on exact decimals."""
    a = money(amount)
    return F.round(a * F.lit(FEE_RATE).cast("decimal(4,3)") + F.lit(FEE_FIXED).cast("decimal(3,2)"), 2).cast(MONEY)


def currency(country="country", eur_countries=EUR_COUNTRIES) -> Column:
    return F.when(_c(country).isin(list(eur_countries)), F.lit("EUR")).otherwise(F.lit("USD"))


def bounced(pageviews="pageviews", duration="session_duration_s") -> Column:
    return ((_c(pageviews) == 1) & (_c(duration) < BOUNCE_MAX_SECONDS)).cast("int")


def campaign(medium="medium") -> Column:
    return F.when(F.lower(_c(medium)).isin(BLANK_CAMPAIGN_MEDIUMS), F.lit("")).otherwise(F.lit(CAMPAIGN_NAME))


def conversion_score(medium="medium", device="device", pageviews="pageviews") -> Column:
    """Base chance plus bonuses, exact as decimal(4,2)."""
    d = "decimal(4,2)"
    m, dev = F.lower(_c(medium)), F.lower(_c(device))
    zero = F.lit("0.00").cast(d)
    return (F.lit(BASE_CONVERSION).cast(d)
            + F.when(m == "cpc", F.lit(CONVERSION_BONUS["cpc"]).cast(d)).otherwise(zero)
            + F.when(m == "email", F.lit(CONVERSION_BONUS["email"]).cast(d)).otherwise(zero)
            + F.when(dev == "desktop", F.lit(CONVERSION_BONUS["desktop"]).cast(d)).otherwise(zero)
            + F.when(_c(pageviews) >= 3, F.lit(CONVERSION_BONUS["pageviews>=3"]).cast(d)).otherwise(zero)
            ).cast(d)


def is_weekend(ts) -> Column:
    return F.dayofweek(_c(ts)).isin(1, 7)


def company_name_from_id(id_col) -> Column:
    return F.concat(F.lit("Company "), F.substring(_c(id_col), 1, 8))


def or_default(x, default, falsy=None) -> Column:
    """``data.get(x) or default``: NULL and the falsy value both take the default."""
    c = _c(x)
    if falsy is not None:
        c = F.nullif(c, F.lit(falsy))
    return F.coalesce(c, default if isinstance(default, Column) else F.lit(default))


def price_table(spark):
    """The five-row list-price table (bounded: one row per product)."""
    return spark.createDataFrame([(p, PRICES[p]) for p in PRODUCTS], "product string, list_price int")
