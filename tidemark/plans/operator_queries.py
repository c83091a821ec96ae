"""Queries for single operators, each over whole input tables.

Every query starts from the raw tables derived from the inputs (so its work
grows with them) and applies one operator; the SQL next to it computes the
same result independently in DuckDB.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.operators import dml, quality
from tidemark.operators.publish import current
from tidemark.operators.watermark import incremental, mark_lit, next_mark, updated_since
from tidemark.plans import staging
from tidemark.plans.gold import Build
from tidemark.plans.oracle import with_models
from tidemark.schemas import MONEY, RAW, RAW_PAYMENTS, RAW_SESSIONS
from tidemark.session import scratch_path
from tidemark.sources import landing
from tidemark.sources.fixtures import pad_id
from tidemark.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed parameters of the registered queries.
AS_OF = dt.datetime(2001, 8, 1)                 # "now" of the stale-customer run
STALE_DAYS = 360
PAYMENTS_CUT = dt.datetime(1998, 6, 30)          # first / second half of payments
SESSIONS_CUT = dt.datetime(2024, 1, 15)          # first / second half of sessions
OLD_MARK = dt.datetime(1998, 1, 1)               # stored mark before the extract
LAST_SEEN_NOW = dt.datetime(1997, 1, 1)          # clock for last_seen_at
LIST_STATUS = "refunded"
LIST_COUNTRY = "NATION_3"
LIST_SOURCE = "PURCHASE"
PAGE, PAGE_SIZE = 3, 500
REFUND_DELAY_DAYS = 30
LATER_COPY_DAYS = 1
# ---------------------------------------------------------------------------

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _ts_sql(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"


RAW_P_COLS = ", ".join(f.name for f in RAW_PAYMENTS.fields)
RAW_S_COLS = ", ".join(f.name for f in RAW_SESSIONS.fields)

# --- SRC4 / SRC5: source filters --------------------------------------------


@query("list_updated_since", with_models(["raw_payments"], f"""
SELECT * FROM raw_payments WHERE coalesce(updated_at, created_at) >= {_ts_sql(OLD_MARK)}
"""))
def list_updated_since(spark, sf_dir):
    return landing.filter_resource(Build(spark, sf_dir).raw_payments, updated_since_ts=OLD_MARK)


@query("list_payments_by_status", with_models(["raw_payments"], f"""
SELECT * FROM raw_payments WHERE status = '{LIST_STATUS}'
"""))
def list_payments_by_status(spark, sf_dir):
    return landing.filter_resource(Build(spark, sf_dir).raw_payments, equals={"status": LIST_STATUS})


@query("list_by_country", with_models(["raw_customers"], f"""
SELECT * FROM raw_customers WHERE country = '{LIST_COUNTRY}'
"""))
def list_by_country(spark, sf_dir):
    return landing.filter_resource(Build(spark, sf_dir).raw_customers, equals={"country": LIST_COUNTRY})


@query("list_sessions_by_source", with_models(["raw_sessions"], f"""
SELECT * FROM raw_sessions WHERE source = '{LIST_SOURCE}'
"""))
def list_sessions_by_source(spark, sf_dir):
    return landing.filter_resource(Build(spark, sf_dir).raw_sessions, equals={"source": LIST_SOURCE})


# --- SRC6: paging -------------------------------------------------------------
_lo, _hi = (PAGE - 1) * PAGE_SIZE + 1, PAGE * PAGE_SIZE


@query("page_slice", with_models(["raw_payments"], f"""
SELECT {RAW_P_COLS}, CAST({PAGE} AS INTEGER) AS page, CAST(rn - {_lo} AS INTEGER) AS pos
FROM (SELECT *, row_number() OVER (ORDER BY payment_id) AS rn FROM raw_payments) r
WHERE rn BETWEEN {_lo} AND {_hi}
"""))
def page_slice(spark, sf_dir):
    return landing.page_slice(Build(spark, sf_dir).raw_payments, "payment_id", PAGE, PAGE_SIZE)


@query("page_totals", with_models(["raw_payments"], f"""
SELECT CAST({PAGE} AS INTEGER) AS page,
       CAST({PAGE_SIZE} AS INTEGER) AS page_size,
       CAST(floor((count(*) + {PAGE_SIZE - 1}) / {PAGE_SIZE}) AS INTEGER) AS total_pages,
       CAST(CASE WHEN {PAGE} < floor((count(*) + {PAGE_SIZE - 1}) / {PAGE_SIZE}) THEN {PAGE + 1} END AS INTEGER) AS next_page,
       CAST(greatest(least(count(*) - {(PAGE - 1) * PAGE_SIZE}, {PAGE_SIZE}), 0) AS INTEGER) AS count,
       CAST(count(*) AS BIGINT) AS total
FROM raw_payments
"""))
def page_totals(spark, sf_dir):
    return landing.page_totals(Build(spark, sf_dir).raw_payments, PAGE, PAGE_SIZE)


# --- HWM1-4 -------------------------------------------------------------------
def _hwm_sql(entity: str, table: str, ts: str) -> str:
    old = _ts_sql(OLD_MARK)
    return f"""
SELECT '{entity}' AS entity, CAST(count(*) AS BIGINT) AS rows,
       CASE WHEN max(updated_at) IS NULL THEN {old}
            ELSE greatest(max(updated_at), {old}) + INTERVAL 1 MICROSECOND END AS next_mark
FROM {table} WHERE {ts} >= {old}"""


@query("hwm_next", with_models(["raw_customers", "raw_payments", "raw_sessions"],
                               _hwm_sql("customers", "raw_customers", "updated_at")
                               + "\nUNION ALL" + _hwm_sql("payments", "raw_payments", "coalesce(updated_at, created_at)")
                               + "\nUNION ALL" + _hwm_sql("sessions", "raw_sessions", "coalesce(updated_at, session_start)")))
def hwm_next(spark, sf_dir):
    """Extract since the stored mark, then the next mark (max + 1 microsecond)."""
    b = Build(spark, sf_dir)
    parts = []
    for entity, df in (("customers", b.raw_customers), ("payments", b.raw_payments), ("sessions", b.raw_sessions)):
        parts.append(updated_since(df, OLD_MARK).agg(
            F.lit(entity).alias("entity"), F.count(F.lit(1)).alias("rows"),
            next_mark("updated_at", OLD_MARK).alias("next_mark")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("incremental_payments", with_models(["stg_payments"], "SELECT * FROM stg_payments"))
def incremental_payments(spark, sf_dir):
    """Staging built from the first half, then the newer rows merged in:
    equals a full build when no row is late."""
    raw = Build(spark, sf_dir).raw_payments
    first = staging.stg_payments(raw.where(F.col("updated_at") <= mark_lit(PAYMENTS_CUT)))
    first = first.checkpoint()   # the stored target of the first run
    new = staging.stg_payments(incremental(raw, first, "updated_at"))
    return dml.merge(first, new, "payment_id")


# --- PRJ6 / PRJ7: landing enrichment -----------------------------------------
@query("last_seen", with_models(["raw_customers"], f"""
SELECT customer_id, greatest(updated_at, {_ts_sql(LAST_SEEN_NOW)}) AS last_seen_at FROM raw_customers
"""))
def last_seen(spark, sf_dir):
    """Service rows carry no last_seen_at: it becomes max(updated_at, now)."""
    rows = landing.to_service_rows(Build(spark, sf_dir).raw_customers, "customers").drop("last_seen_at")
    return rows.select("customer_id", landing.last_seen("updated_at", None, LAST_SEEN_NOW).alias("last_seen_at"))


def _iso_sql(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"


@query("lineage", with_models(["raw_payments"], f"""
SELECT payment_id, customer_id, product, CAST(amount AS DOUBLE) AS amount, currency, status,
       CAST(refunded_amount AS DOUBLE) AS refunded_amount, CAST(fee AS DOUBLE) AS fee,
       payment_method, country, {_iso_sql('created_at')} AS created_at, {_iso_sql('updated_at')} AS updated_at,
       '{AS_OF.isoformat()}' AS ingestion_ts, 'payments' AS source_endpoint,
       '{landing.run_id(AS_OF)}' AS run_id, CAST(NULL AS VARCHAR) AS landed, CAST(NULL AS INTEGER) AS page, CAST(NULL AS INTEGER) AS pos,
       DATE '{AS_OF.date().isoformat()}' AS ingestion_date
FROM raw_payments
"""))
def lineage(spark, sf_dir):
    rows = landing.to_service_rows(Build(spark, sf_dir).raw_payments, "payments")
    return landing.add_lineage(rows, "payments", AS_OF)


# --- DML1-5 -------------------------------------------------------------------
def customer_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers re-landed once per order they place: updated and seen at the
    order time, churned when that order is finished.  Arrival order is
    (order time, order key); most customers arrive many times."""
    cust = Build(spark, sf_dir).raw_customers
    orders = read_table(spark, sf_dir, "orders").select(
        pad_id("o_custkey").alias("customer_id"), "o_orderkey", "o_orderdate", "o_orderstatus")
    return (cust.drop("updated_at", "last_seen_at", "is_churned").join(orders, "customer_id")
                .select("customer_id", "company_name", "country", "industry", "company_size", "signup_date",
                        F.col("o_orderdate").alias("updated_at"),
                        (F.col("o_orderstatus") == "F").alias("is_churned"),
                        F.col("o_orderdate").alias("last_seen_at"),
                        F.col("o_orderdate").alias("arrived_at"),
                        F.col("o_orderkey").alias("arrival_seq")))


CUSTOMER_BATCH_SQL = """
SELECT c.customer_id, c.company_name, c.country, c.industry, c.company_size, c.signup_date,
       o.o_orderdate AS updated_at, o.o_orderstatus = 'F' AS is_churned, o.o_orderdate AS last_seen_at,
       o.o_orderdate AS arrived_at, o.o_orderkey AS arrival_seq
FROM raw_customers c JOIN orders o ON c.customer_id = lpad(CAST(o.o_custkey AS VARCHAR), 10, '0')
"""
LAST_CUSTOMER_SQL = f"""
SELECT customer_id, company_name, country, industry, company_size, signup_date, updated_at, is_churned,
       last_seen_at, arrived_at, arrival_seq
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY arrived_at DESC, arrival_seq DESC) AS rn
      FROM ({CUSTOMER_BATCH_SQL}) b) r
WHERE rn = 1
"""
CUSTOMER_ORDER = ["arrived_at", "arrival_seq"]


@query("latest_in_batch", with_models(["raw_customers"], LAST_CUSTOMER_SQL))
def latest_in_batch(spark, sf_dir):
    return dml.last_in_batch(customer_batch(spark, sf_dir), "customer_id", CUSTOMER_ORDER)


@query("key_violations", with_models(["raw_customers"], f"""
SELECT CASE WHEN arrival_seq % 50 <> 0 THEN customer_id END AS customer_id, CAST(count(*) AS BIGINT) AS n
FROM ({CUSTOMER_BATCH_SQL}) b
GROUP BY 1 HAVING count(*) > 1 OR max(customer_id) FILTER (arrival_seq % 50 <> 0) IS NULL
"""))
def key_violations(spark, sf_dir):
    """A load whose batch repeats keys and has lost every fiftieth one: the keys that a primary key refuses."""
    batch = customer_batch(spark, sf_dir).withColumn("customer_id", F.when(F.col("arrival_seq") % 50 != 0, F.col("customer_id")))
    return quality.key_violations(batch, "customer_id")


@query("upsert_customers", with_models(["raw_customers"], f"""
SELECT t.* FROM raw_customers t
WHERE NOT EXISTS (SELECT 1 FROM ({CUSTOMER_BATCH_SQL}) b WHERE b.customer_id = t.customer_id)
UNION ALL
SELECT customer_id, company_name, country, industry, company_size, signup_date, updated_at, is_churned,
       last_seen_at, false AS is_deleted
FROM ({LAST_CUSTOMER_SQL}) l
"""))
def upsert_customers(spark, sf_dir):
    """Replace every customer seen in the batch by its last arrival; revive it."""
    target = Build(spark, sf_dir).raw_customers
    return dml.upsert(target, customer_batch(spark, sf_dir), "customer_id", on_match="update",
                      order=CUSTOMER_ORDER, revive="is_deleted")


def _later_copy(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "pageviews": F.col("pageviews") + 1,
        "updated_at": F.col("updated_at") + F.make_dt_interval(F.lit(LATER_COPY_DAYS)),
    })


@query("insert_only_sessions", with_models(["raw_sessions"], f"""
SELECT * FROM raw_sessions WHERE session_start <= {_ts_sql(SESSIONS_CUT)}
UNION ALL
SELECT session_id, customer_id, source, medium, campaign, device, country,
       pageviews + 1 AS pageviews, session_duration_s, bounced, converted, session_start,
       updated_at + INTERVAL {LATER_COPY_DAYS} DAY AS updated_at
FROM raw_sessions WHERE session_start > {_ts_sql(SESSIONS_CUT)}
"""))
def insert_only_sessions(spark, sf_dir):
    """Target: the first half.  Batch: every session twice, a changed copy
    first; insert-only keeps existing rows and inserts the first arrival."""
    raw = Build(spark, sf_dir).raw_sessions
    target = raw.where(F.col("session_start") <= mark_lit(SESSIONS_CUT))
    batch = (_later_copy(raw).withColumn("page", F.lit(1))
             .unionByName(raw.withColumn("page", F.lit(2)))
             .withColumn("pos", F.lit(0)))
    return dml.upsert(target, batch, "session_id", on_match="nothing")


REFUND_COLS = ["status", "refunded_amount", "net_revenue", "updated_at"]


def refund_batch(stg: DataFrame) -> DataFrame:
    """Refunded payments re-sent as full refunds, a month later."""
    return (stg.where(F.col("status") == "refunded")
               .withColumns({
                   "refunded_amount": F.col("amount"),
                   "net_revenue": rules.net_revenue("amount", "fee", "amount"),
                   "updated_at": F.col("updated_at") + F.make_dt_interval(F.lit(REFUND_DELAY_DAYS)),
               }))


@query("merge_payments", with_models(["stg_payments"], f"""
SELECT t.* FROM stg_payments t
WHERE t.updated_at <= {_ts_sql(PAYMENTS_CUT)} AND t.status <> 'refunded'
UNION ALL
SELECT payment_id, customer_id, product, amount, currency, status, amount AS refunded_amount, fee,
       payment_method, country, created_at,
       updated_at + INTERVAL {REFUND_DELAY_DAYS} DAY AS updated_at,
       CAST(amount - coalesce(fee, 0) - coalesce(amount, 0) AS DECIMAL(18,2)) AS net_revenue, order_day
FROM stg_payments WHERE status = 'refunded'
"""))
def merge_payments(spark, sf_dir):
    """Merge refunds into the first-half staging table, updating only the
    refund columns of matched rows and inserting the others whole."""
    stg = Build(spark, sf_dir).stg_payments
    target = stg.where(F.col("updated_at") <= mark_lit(PAYMENTS_CUT))
    return dml.merge(target, refund_batch(stg), "payment_id", update_cols=REFUND_COLS)


@query("soft_delete_customers", with_models(["raw_customers"], f"""
SELECT customer_id, company_name, country, industry, company_size, signup_date,
       CASE WHEN last_seen_at < {_ts_sql(AS_OF)} - INTERVAL {STALE_DAYS} DAY AND is_deleted = false
            THEN {_ts_sql(AS_OF)} ELSE updated_at END AS updated_at,
       is_churned, last_seen_at,
       CASE WHEN last_seen_at < {_ts_sql(AS_OF)} - INTERVAL {STALE_DAYS} DAY AND is_deleted = false
            THEN true ELSE is_deleted END AS is_deleted
FROM raw_customers
"""))
def soft_delete_customers(spark, sf_dir):
    return dml.soft_delete(Build(spark, sf_dir).raw_customers, AS_OF, STALE_DAYS)


# --- ENR1-10: business rules ---------------------------------------------------
@query("fee_rule", with_models(["raw_payments"], """
SELECT payment_id, amount, CAST(round(amount * 0.029 + 0.30, 2) AS DECIMAL(18,2)) AS fee_rule FROM raw_payments
"""))
def fee_rule(spark, sf_dir):
    p = Build(spark, sf_dir).raw_payments
    return p.select("payment_id", "amount", rules.fee("amount").alias("fee_rule"))


# Payments as the service sends them: some in list products and euro countries, some values missing or
# blank.  The SQL spells the cases and the rules' constants out by hand.
def service_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Build(spark, sf_dir).raw_payments
    k = F.col("payment_id").cast("long")
    pick = lambda step, values, c: F.coalesce(F.get(F.array(*[F.lit(v) for v in values]), (k % step).cast("int")), F.col(c))
    return (p.withColumn("product", pick(7, rules.PRODUCTS, "product"))
             .withColumn("country", pick(11, rules.EUR_COUNTRIES, "country"))
             .withColumn("amount", F.when(k % 13 == 0, F.lit(0).cast(MONEY)).when(k % 17 != 0, F.col("amount")))
             .withColumn("currency", F.when(k % 5 == 0, "").when(k % 9 != 0, F.col("currency")))
             .withColumn("status", F.when(k % 8 == 1, "").when(k % 10 != 3, F.col("status"))))


SERVICE_PAYMENTS_SQL = """
SELECT payment_id, customer_id, refunded_amount, fee,
       CASE k % 7 WHEN 0 THEN 'Basic' WHEN 1 THEN 'Pro' WHEN 2 THEN 'Enterprise' WHEN 3 THEN 'Addon-Analytics'
                  WHEN 4 THEN 'Addon-Support' ELSE product END AS product,
       CASE k % 11 WHEN 0 THEN 'DE' WHEN 1 THEN 'FR' WHEN 2 THEN 'NL' WHEN 3 THEN 'PT' WHEN 4 THEN 'IT' WHEN 5 THEN 'ES'
                   ELSE country END AS country,
       CAST(CASE WHEN k % 13 = 0 THEN 0 WHEN k % 17 <> 0 THEN amount END AS DECIMAL(18,2)) AS amount,
       CASE WHEN k % 5 = 0 THEN '' WHEN k % 9 <> 0 THEN currency END AS currency,
       CASE WHEN k % 8 = 1 THEN '' WHEN k % 10 <> 3 THEN status END AS status
FROM (SELECT *, CAST(payment_id AS BIGINT) AS k FROM raw_payments) numbered"""
PRICE_LIST_SQL = "(VALUES ('Basic', 29), ('Pro', 99), ('Enterprise', 499), ('Addon-Analytics', 49), ('Addon-Support', 99))"


@query("currency_rule", with_models(["raw_payments"], f"""
SELECT payment_id, country,
       CASE WHEN country IN ('DE', 'FR', 'NL', 'PT', 'IT', 'ES') THEN 'EUR' ELSE 'USD' END AS currency_rule
FROM ({SERVICE_PAYMENTS_SQL}) p
"""))
def currency_rule(spark, sf_dir):
    p = service_payments(spark, sf_dir)
    return p.select("payment_id", "country", rules.currency("country").alias("currency_rule"))


@query("bounce_rule", with_models(["raw_sessions"], """
SELECT session_id, pageviews, session_duration_s,
       CAST(pageviews = 1 AND session_duration_s < 10 AS INTEGER) AS bounce_rule
FROM raw_sessions
"""))
def bounce_rule(spark, sf_dir):
    s = Build(spark, sf_dir).raw_sessions
    return s.select("session_id", "pageviews", "session_duration_s", rules.bounced().alias("bounce_rule"))


@query("campaign_rule", with_models(["raw_sessions"], f"""
SELECT session_id, medium,
       CASE WHEN lower(medium) IN ('organic', 'none', 'referral') THEN '' ELSE 'product_launch' END AS campaign_rule
FROM raw_sessions
"""))
def campaign_rule(spark, sf_dir):
    s = Build(spark, sf_dir).raw_sessions
    return s.select("session_id", "medium", rules.campaign("medium").alias("campaign_rule"))


@query("conversion_score", with_models(["stg_sessions"], """
SELECT session_id,
       CAST(0.02 + CASE WHEN lower(medium) = 'cpc' THEN 0.02 ELSE 0 END
                 + CASE WHEN lower(medium) = 'email' THEN 0.03 ELSE 0 END
                 + CASE WHEN lower(device) = 'desktop' THEN 0.01 ELSE 0 END
                 + CASE WHEN pageviews >= 3 THEN 0.01 ELSE 0 END AS DECIMAL(4,2)) AS conversion_score
FROM stg_sessions
"""))
def conversion_score(spark, sf_dir):
    s = Build(spark, sf_dir).stg_sessions
    return s.select("session_id", rules.conversion_score().alias("conversion_score"))


@query("price_join", with_models(["raw_payments"], f"""
SELECT p.payment_id, p.product, p.amount, pr.list_price,
       CAST(CASE WHEN pr.list_price IS NOT NULL THEN p.amount / pr.list_price END AS DOUBLE) AS seats
FROM ({SERVICE_PAYMENTS_SQL}) p
LEFT JOIN {PRICE_LIST_SQL} AS pr(product, list_price) ON p.product = pr.product
"""))
def price_join(spark, sf_dir):
    """List price by product (the five-row price table, broadcast) and
    seats = amount / price; products outside the price list get NULL."""
    p = service_payments(spark, sf_dir)
    j = p.join(F.broadcast(rules.price_table(spark)), "product", "left")   # five rows by construction
    return j.select("payment_id", "product", "amount", "list_price",
                    F.when(F.col("list_price").isNotNull(),
                           (F.col("amount") / F.col("list_price")).cast("double")).alias("seats"))


@query("fill_defaults", with_models(["raw_payments"], f"""
SELECT p.payment_id,
       CAST(coalesce(nullif(p.amount, 0), pr.list_price) AS DECIMAL(18,2)) AS amount,
       coalesce(nullif(p.currency, ''), 'USD') AS currency,
       coalesce(nullif(p.status, ''), 'succeeded') AS status,
       CAST(coalesce(nullif(p.refunded_amount, 0), 0) AS DECIMAL(18,2)) AS refunded_amount,
       CAST(coalesce(nullif(p.fee, 0),
                     round(CAST(coalesce(nullif(p.amount, 0), pr.list_price) AS DECIMAL(18,2)) * 0.029 + 0.30, 2))
            AS DECIMAL(18,2)) AS fee
FROM ({SERVICE_PAYMENTS_SQL}) p
LEFT JOIN {PRICE_LIST_SQL} AS pr(product, list_price) ON p.product = pr.product
"""))
def fill_defaults(spark, sf_dir):
    """``value or default`` on insert: a NULL or falsy value takes the default
    (list price, USD, succeeded, no refund, the fee rule)."""
    p = service_payments(spark, sf_dir)
    j = p.join(F.broadcast(rules.price_table(spark)), "product", "left")   # five rows by construction
    amount = rules.or_default("amount", F.col("list_price").cast(MONEY), falsy=0).cast(MONEY)
    return j.select(
        "payment_id",
        amount.alias("amount"),
        rules.or_default("currency", "USD", falsy="").alias("currency"),
        rules.or_default("status", "succeeded", falsy="").alias("status"),
        rules.or_default("refunded_amount", F.lit(0).cast(MONEY), falsy=0).cast(MONEY).alias("refunded_amount"),
        rules.or_default("fee", rules.fee(amount), falsy=0).cast(MONEY).alias("fee"))


@query("weekend_sessions", with_models(["raw_sessions"], """
SELECT session_id, session_start, dayofweek(session_start) IN (0, 6) AS is_weekend FROM raw_sessions
"""))
def weekend_sessions(spark, sf_dir):
    s = Build(spark, sf_dir).raw_sessions
    return s.select("session_id", "session_start", rules.is_weekend("session_start").alias("is_weekend"))


# --- Landing round trip and the streaming upsert ------------------------------
@query("bronze_roundtrip", with_models(["raw_payments"], "SELECT * FROM raw_payments"))
def bronze_roundtrip(spark, sf_dir):
    """raw -> list pages -> landed JSON -> envelopes -> bronze -> raw types."""
    raw = Build(spark, sf_dir).raw_payments
    base = scratch_path(spark, "bronze")
    landing.write_landing(landing.paginate(raw, "payments", "payment_id", landing.PAGE_SIZE_DEFAULT), f"{base}/landing")
    rows = landing.read_envelopes(spark, f"{base}/landing", "payments")
    landing.write_bronze(landing.add_lineage(rows, "payments", AS_OF), f"{base}/bronze", "payments")
    bronze = landing.read_bronze(spark, f"{base}/bronze", "payments", since_date=AS_OF.date())
    return landing.to_raw(bronze, "payments")


def two_runs(spark: SparkSession, entity: str, first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Two landed runs that share keys but not page positions (other page sizes), through bronze into an empty raw table."""
    base = scratch_path(spark, f"two-runs-{entity}")
    for i, (rows, size) in enumerate(((first, 500), (second, 300))):
        landing.write_landing(landing.paginate(rows, entity, key, size), f"{base}/landing/run={9 + i}")
    pages = landing.read_pages(spark, f"{base}/landing/*", entity)
    landing.write_bronze(landing.add_lineage(landing.explode_pages(pages), entity, AS_OF), f"{base}/bronze", entity)
    batch = landing.to_raw(landing.read_bronze(spark, f"{base}/bronze", entity), entity, keep=landing.BRONZE_ORDER)
    return dml.upsert(spark.createDataFrame([], RAW[entity]), batch, key, on_match="nothing" if entity == "sessions" else "update",
                      order=landing.BRONZE_ORDER, revive="is_deleted" if entity == "customers" else None)


@query("landing_two_runs_payments", with_models(["raw_payments"], """
SELECT payment_id, customer_id, product, CAST(CASE WHEN CAST(payment_id AS BIGINT) % 3 = 0 THEN amount + 10 ELSE amount END AS DECIMAL(18,2)) AS amount,
       currency, status, refunded_amount, fee, payment_method, country, created_at, updated_at
FROM raw_payments
"""))
def landing_two_runs_payments(spark, sf_dir):
    """Run 9 lands every payment with another amount, run 10 two thirds of them as they are: the later run's rows stay."""
    raw = Build(spark, sf_dir).raw_payments
    changed = raw.withColumn("amount", (F.col("amount") + 10).cast(MONEY))
    return two_runs(spark, "payments", changed, raw.where(F.col("payment_id").cast("long") % 3 != 0), "payment_id")


@query("landing_two_runs_sessions", with_models(["raw_sessions"], """
SELECT session_id, customer_id, source, medium, campaign, device, country,
       CASE WHEN CAST(session_id AS BIGINT) % 4 <> 0 THEN pageviews + 1 ELSE pageviews END AS pageviews,
       session_duration_s, bounced, converted, session_start, updated_at
FROM raw_sessions
"""))
def landing_two_runs_sessions(spark, sf_dir):
    """Run 9 lands three quarters of the sessions with another count, run 10 all as they are: the first arrival stays."""
    raw = Build(spark, sf_dir).raw_sessions
    changed = raw.withColumn("pageviews", F.col("pageviews") + 1).where(F.col("session_id").cast("long") % 4 != 0)
    return two_runs(spark, "sessions", changed, raw, "session_id")


@query("landing_two_runs_customers", with_models(["raw_customers"], f"""
SELECT customer_id, CASE WHEN CAST(customer_id AS BIGINT) % 3 = 0 THEN concat(company_name, ' (old)') ELSE company_name END AS company_name,
       country, industry, company_size, signup_date, updated_at, is_churned,
       greatest(updated_at, CASE WHEN CAST(customer_id AS BIGINT) % 2 = 0 THEN last_seen_at ELSE {_ts_sql(AS_OF)} END) AS last_seen_at,
       false AS is_deleted
FROM raw_customers
"""))
def landing_two_runs_customers(spark, sf_dir):
    """As for payments; half of the rows bring a last_seen_at, the others take the clock; deleted customers come back."""
    raw = Build(spark, sf_dir).raw_customers
    raw = raw.withColumn("last_seen_at", F.when(F.col("customer_id").cast("long") % 2 == 0, F.col("last_seen_at")))
    old = raw.withColumn("company_name", F.concat("company_name", F.lit(" (old)")))
    return two_runs(spark, "customers", old, raw.where(F.col("customer_id").cast("long") % 3 != 0), "customer_id")


@query("stream_upsert", with_models(["raw_sessions"], "SELECT * FROM raw_sessions"))
def stream_upsert(spark, sf_dir):
    """Two landed runs (halves by time) streamed insert-only into raw.sessions."""
    from tidemark.streaming.upsert_stream import run_stream
    raw = Build(spark, sf_dir).raw_sessions
    base = scratch_path(spark, "stream")
    cut = mark_lit(SESSIONS_CUT)
    for i, part in enumerate((raw.where(F.col("session_start") <= cut), raw.where(F.col("session_start") > cut))):
        landing.write_landing(landing.paginate(part, "sessions", "session_id"), f"{base}/landing/run={i}")
    run_stream(spark, f"{base}/landing/*", "sessions", f"{base}/checkpoint", f"{base}/raw")
    return current(spark, f"{base}/raw", "sessions", RAW_SESSIONS)


@query("customer_defaults", with_models(["raw_customers"], f"""
SELECT customer_id,
       CASE WHEN k % 4 = 0 THEN concat('Company ', substr(customer_id, 1, 8)) ELSE company_name END AS company_name,
       concat('Company ', substr(customer_id, 1, 8)) AS default_name,
       CASE WHEN k % 6 = 0 THEN false ELSE is_churned END AS is_churned,
       CASE WHEN k % 5 = 0 THEN {_ts_sql(AS_OF)} ELSE signup_date END AS signup_date,
       CASE WHEN k % 7 = 0 THEN {_ts_sql(AS_OF)} ELSE updated_at END AS updated_at
FROM (SELECT *, CAST(customer_id AS BIGINT) AS k FROM raw_customers) c
"""))
def customer_defaults(spark, sf_dir):
    """``data.get(x, default)`` on a customer insert: only a missing value
    takes the default (name from the id, not churned, times = now)."""
    k = F.col("customer_id").cast("long")
    c = Build(spark, sf_dir).raw_customers.withColumns({   # values that the service left out
        name: F.when(k % step != 0, F.col(name))
        for name, step in (("company_name", 4), ("signup_date", 5), ("is_churned", 6), ("updated_at", 7))})
    now = mark_lit(AS_OF)
    return c.select(
        "customer_id",
        rules.or_default("company_name", rules.company_name_from_id("customer_id")).alias("company_name"),
        rules.company_name_from_id("customer_id").alias("default_name"),
        rules.or_default("is_churned", False).alias("is_churned"),
        rules.or_default("signup_date", now).alias("signup_date"),
        rules.or_default("updated_at", now).alias("updated_at"))
