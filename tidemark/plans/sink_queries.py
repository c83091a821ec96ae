"""Queries for the sinks, the marks, the commit log and what is built on it.

As in ``operator_queries``, each starts from the raw tables derived from the inputs and has its SQL next to it.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import dml
from tidemark.operators.keyindex import KeyIndex
from tidemark.operators.publish import current, ensure_layers, ensure_table, publish, qualified, register, table_exists, versions
from tidemark.operators.tablelog import LogTable
from tidemark.operators.watermark import default_mark, get_watermark, mark_lit, newer_than, next_mark, set_watermark, updated_since
from tidemark.plans import pipeline, sketches, staging
from tidemark.plans.gold import Build
from tidemark.plans.operator_queries import (AS_OF, CUSTOMER_BATCH_SQL, CUSTOMER_ORDER, LAST_CUSTOMER_SQL, LATER_COPY_DAYS, OLD_MARK, ORACLE, PAGE, PAGE_SIZE,
                                             PAYMENTS_CUT, SESSIONS_CUT, STALE_DAYS, _later_copy, _ts_sql, customer_batch, query)
from tidemark.plans.oracle import with_models
from tidemark.schemas import KEYS, RAW, RAW_PAYMENTS
from tidemark.session import scratch_path
from tidemark.sources import landing, quarantine

BUCKETS = 16
DAY = dt.datetime(1996, 3, 1)                    # the day that a time slice reads
DAYS = 31


def log_table(spark: SparkSession, tag: str, **layout) -> LogTable:
    return LogTable(spark, scratch_path(spark, tag), **layout)


# --- SNK1, SNK2, SNK12: bronze runs and their counts --------------------------------
@query("bronze_runs", with_models(["raw_customers", "raw_payments", "raw_sessions"], f"""
SELECT 'customers' AS entity, CAST(count(*) AS BIGINT) AS written_rows, CAST(count(*) AS BIGINT) AS stored_rows, max(updated_at) AS max_ts FROM raw_customers
UNION ALL SELECT 'payments', CAST(count(*) AS BIGINT), CAST(count(*) AS BIGINT), max(updated_at) FROM raw_payments WHERE updated_at >= {_ts_sql(OLD_MARK)}
UNION ALL SELECT 'sessions', CAST(0 AS BIGINT), CAST(0 AS BIGINT), NULL FROM (SELECT 1)
"""))
def bronze_runs(spark, sf_dir):
    """One run per entity: all customers, payments since the mark, and no session (nothing is written then).

    Counts and newest times are those that each write reported; the stored rows are counted again."""
    b, root = Build(spark, sf_dir), scratch_path(spark, "bronze")
    extracts = {"customers": b.raw_customers, "payments": updated_since(b.raw_payments, OLD_MARK), "sessions": b.raw_sessions.where(F.lit(False))}
    out = None
    for entity, rows in extracts.items():
        stats = landing.write_bronze(landing.add_lineage(landing.to_service_rows(rows, entity), entity, AS_OF), root, entity)
        one = landing.read_bronze(spark, root, entity).agg(
            F.lit(entity).alias("entity"), F.lit(stats["rows"]).cast("long").alias("written_rows"), F.count(F.lit(1)).alias("stored_rows"),
            F.lit(str(stats["max_ts"]) if stats["max_ts"] else None).cast("timestamp_ntz").alias("max_ts"))
        out = one if out is None else out.unionByName(one)
    return out


# --- HWM1-HWM3: stored marks ---------------------------------------------------------
@query("stored_marks", with_models(["raw_customers", "raw_payments", "raw_sessions"], " UNION ALL ".join(f"""
SELECT '{entity}' AS entity, {_ts_sql(default_mark(AS_OF))} AS first_mark,
       CASE WHEN max(updated_at) FILTER (updated_at >= {_ts_sql(default_mark(AS_OF))}) IS NULL THEN {_ts_sql(default_mark(AS_OF))}
            ELSE max(updated_at) + INTERVAL 1 MICROSECOND END AS second_mark,
       CAST(count(*) FILTER (updated_at >= {_ts_sql(default_mark(AS_OF))}) AS BIGINT) AS first_rows, CAST(0 AS BIGINT) AS second_rows
FROM raw_{entity}""" for entity in KEYS)))
def stored_marks(spark, sf_dir):
    """Two extracts per entity: without a stored mark from 365 days before the run, then from the mark that the
    first one left behind (where nothing is newer any more)."""
    b, root = Build(spark, sf_dir), scratch_path(spark, "marks")
    out = []
    for entity in KEYS:
        raw, marks, rows = getattr(b, f"raw_{entity}"), [], []
        for _ in range(2):
            marks.append(get_watermark(spark, root, f"wm_{entity}", default_mark(AS_OF)))
            got = updated_since(raw, marks[-1]).agg(F.count(F.lit(1)).alias("n"), next_mark("updated_at", marks[-1]).alias("m")).first()
            rows.append(got["n"])
            if got["n"]:
                set_watermark(spark, root, f"wm_{entity}", got["m"])
        out.append((entity, *map(str, marks), *rows))
    made = spark.createDataFrame(out, "entity string, first_mark string, second_mark string, first_rows long, second_rows long")
    return made.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_mark", "second_mark")})


# --- SNK3, SNK5-SNK8: published tables in the catalog -----------------------------------
@query("publish_roundtrip", with_models(["raw_payments"], f"""
SELECT *, CAST(2 AS BIGINT) AS versions FROM raw_payments WHERE updated_at > {_ts_sql(PAYMENTS_CUT)}
"""))
def publish_roundtrip(spark, sf_dir):
    """A table published twice: readers take the second version, the first one stays."""
    raw, root = Build(spark, sf_dir).raw_payments, scratch_path(spark, "publish")
    cut = mark_lit(PAYMENTS_CUT)
    for part in (raw.where(F.col("updated_at") <= cut), raw.where(F.col("updated_at") > cut)):
        publish(part, root, "payments", cluster_by="created_at")
    return current(spark, root, "payments", RAW_PAYMENTS).withColumn("versions", F.lit(len(versions(spark, root, "payments"))).cast("long"))


@query("catalog_roundtrip", with_models(["raw_customers"], """
SELECT *, false AS existed, true AS exists_empty, CAST(0 AS BIGINT) AS empty_rows FROM raw_customers
"""))
def catalog_roundtrip(spark, sf_dir):
    """Layer made if missing, empty typed table made if missing, filled by a publish, read by its routed name."""
    layer, root = f"raw_{uuid.uuid4().hex[:12]}", scratch_path(spark, "catalog")
    ensure_layers(spark, root, [layer])
    existed = table_exists(spark, f"{root}/{layer}", "customers")
    ensure_table(spark, f"{root}/{layer}", "customers", RAW["customers"])
    made = table_exists(spark, f"{root}/{layer}", "customers")
    register(spark, root, layer, "customers")
    empty_rows = spark.table(qualified("customers", layer, "public")).count()
    publish(Build(spark, sf_dir).raw_customers, f"{root}/{layer}", "customers")
    register(spark, root, layer, "customers")
    return spark.table(qualified("customers", None, layer)).withColumns(
        {"existed": F.lit(existed), "exists_empty": F.lit(made), "empty_rows": F.lit(empty_rows).cast("long")})


# --- SNK4: incremental table over two runs ------------------------------------------------
@query("staging_two_runs", with_models(["stg_payments"], "SELECT * FROM stg_payments"))
def staging_two_runs(spark, sf_dir):
    """Raw and staging payments kept in log tables: two landed halves, upserted, staged from the mark in the log."""
    raw, root = Build(spark, sf_dir).raw_payments, scratch_path(spark, "runs")
    cut = mark_lit(PAYMENTS_CUT)
    for part in (raw.where(F.col("updated_at") <= cut), raw.where(F.col("updated_at") > cut)):
        batch = part.withColumns({c: F.lit(AS_OF.isoformat()) if c == "ingestion_ts" else F.lit("x") if c == "landed" else F.lit(1)
                                  for c in landing.BRONZE_ORDER})
        pipeline.upsert_raw_in_place(spark, root, "payments", batch, buckets=BUCKETS)
        pipeline.refresh_staging(spark, root, "payments", in_place=True, buckets=BUCKETS)
    return pipeline.read_staging(spark, root, "stg_payments", in_place=True)


# --- SNK11: time index ----------------------------------------------------------------------
@query("time_slice", with_models(["raw_payments"], f"""
SELECT * FROM raw_payments WHERE created_at >= {_ts_sql(DAY)} AND created_at < {_ts_sql(DAY + dt.timedelta(days=DAYS))}
"""))
def time_slice(spark, sf_dir):
    """A month of payments from a table in ranges of its time: only files of these days are opened."""
    t = log_table(spark, "slice", cluster="created_at")
    t.append(Build(spark, sf_dir).raw_payments)
    return t.between(DAY, DAY + dt.timedelta(days=DAYS))


# --- DML1, DML2, JN12 through the key filters -------------------------------------------------
@query("pruned_upsert", with_models(["raw_customers"], f"""
SELECT t.* FROM raw_customers t
WHERE NOT EXISTS (SELECT 1 FROM ({CUSTOMER_BATCH_SQL}) b WHERE b.customer_id = t.customer_id)
UNION ALL
SELECT customer_id, company_name, country, industry, company_size, signup_date, updated_at, is_churned, last_seen_at, false AS is_deleted
FROM ({LAST_CUSTOMER_SQL}) l
"""))
def pruned_upsert(spark, sf_dir):
    """Customers re-landed once per order, upserted where the key filters say that a file may hold them."""
    t = log_table(spark, "upsert", key="customer_id", buckets=BUCKETS)
    t.replace(Build(spark, sf_dir).raw_customers)
    batch = customer_batch(spark, sf_dir).withColumn("is_deleted", F.lit(False))
    t.upsert(batch, CUSTOMER_ORDER)
    return t.read()


@query("pruned_insert", with_models(["raw_sessions"], f"""
SELECT * FROM raw_sessions WHERE session_start <= {_ts_sql(SESSIONS_CUT)}
UNION ALL
SELECT session_id, customer_id, source, medium, campaign, device, country, pageviews + 1 AS pageviews, session_duration_s, bounced, converted, session_start,
       updated_at + INTERVAL {LATER_COPY_DAYS} DAY AS updated_at
FROM raw_sessions WHERE session_start > {_ts_sql(SESSIONS_CUT)}
"""))
def pruned_insert(spark, sf_dir):
    """The first half is there; every session comes twice, a changed copy first: only new keys go in, the first arrival of each."""
    raw = Build(spark, sf_dir).raw_sessions
    t = log_table(spark, "insert", key="session_id", buckets=BUCKETS)
    t.replace(raw.where(F.col("session_start") <= mark_lit(SESSIONS_CUT)))
    t.insert_new(_later_copy(raw).withColumn("page", F.lit(1)).unionByName(raw.withColumn("page", F.lit(2))).withColumn("pos", F.lit(0)), dml.ARRIVAL)
    return t.read()


# --- HWM4, AGG8: the mark from the log ----------------------------------------------------------
@query("mark_from_log", with_models(["stg_payments"], "SELECT * FROM stg_payments"))
def mark_from_log(spark, sf_dir):
    """Staging from the first half, then what is newer than the mark that its log holds."""
    raw = Build(spark, sf_dir).raw_payments
    t = log_table(spark, "mark", key="payment_id", buckets=BUCKETS, tracked=["updated_at"])
    t.replace(staging.stg_payments(raw.where(F.col("updated_at") <= mark_lit(PAYMENTS_CUT))))
    t.upsert(staging.stg_payments(newer_than(raw, t.mark("updated_at"))), order=None)
    return t.read()


@query("mark_after_soft_delete", with_models(["raw_customers"], f"""
SELECT greatest(max(updated_at), max(CASE WHEN last_seen_at < {_ts_sql(AS_OF)} - INTERVAL {STALE_DAYS} DAY AND is_deleted = false
                                          THEN {_ts_sql(AS_OF)} END)) AS mark,
       CAST(count(*) FILTER (last_seen_at < {_ts_sql(AS_OF)} - INTERVAL {STALE_DAYS} DAY AND is_deleted = false) AS BIGINT) AS deleted_rows,
       CAST(count(*) AS BIGINT) AS n_rows
FROM raw_customers
"""))
def mark_after_soft_delete(spark, sf_dir):
    """Only files with a stale customer are rewritten; mark and row count stand in the log."""
    t = log_table(spark, "stale", key="customer_id", buckets=BUCKETS, tracked=["updated_at"])
    t.replace(Build(spark, sf_dir).raw_customers)
    before = t.latest().version
    t.rewrite(dml.stale_flag(AS_OF, STALE_DAYS), lambda df: dml.soft_delete(df, AS_OF, STALE_DAYS))
    c = t.latest()
    moved = t.changes(before) if c.version != before else None
    deleted = moved.where("_weight > 0") if moved is not None else t.read().where(F.lit(False))
    mark = t.mark("updated_at")
    return deleted.agg(F.lit(str(mark) if mark else None).cast("timestamp_ntz").alias("mark"), F.count(F.lit(1)).alias("deleted_rows"),
                       F.lit(c.rows).cast("long").alias("n_rows"))


# --- WIN1, SRC6, LIM1: keys and pages from ranges with counts -----------------------------------------
@query("keys_over_runs", with_models(["dim_customer"], "SELECT * FROM dim_customer"))
def keys_over_runs(spark, sf_dir):
    """The customer dimension's keys kept over three runs of new members, the first one two thirds of them."""
    cust = Build(spark, sf_dir).stg_customers.select("customer_id", "company_name", "country", "industry", "company_size", "signup_date", "updated_at", "is_churned")
    index = KeyIndex(spark, scratch_path(spark, "keys"), ["customer_id"], range_rows=5_000)
    number = F.col("customer_id").cast("long")
    for part in (number % 3 != 0, number % 6 == 0, number % 6 == 3):
        index.add(cust.where(part))
    found = index.read("customer_key")
    return found if found is not None else cust.select(F.lit(0).cast("bigint").alias("customer_key"), "*").limit(0)


@query("page_index", ORACLE["page_slice"])
def page_index(spark, sf_dir):
    """One page of the payments list, read from the ranges that hold it."""
    raw = Build(spark, sf_dir).raw_payments
    index = KeyIndex(spark, scratch_path(spark, "pages"), ["payment_id"], range_rows=20_000)
    index.add(raw)
    return index.page(PAGE, PAGE_SIZE) if index.log.exists() else raw.limit(0).withColumns({"page": F.lit(PAGE), "pos": F.lit(0)})


# --- AGG4: approximate distinct, opt-in ------------------------------------------------------------------
@query("approx_customers", with_models(["stg_payments"], """
SELECT CAST(date_trunc('month', order_day) AS DATE) AS order_month, country, CAST(count(DISTINCT customer_id) AS BIGINT) AS active_customers,
       true AS within_bound
FROM stg_payments GROUP BY 1, 2
"""))
def approx_customers(spark, sf_dir):
    """Sketches per day, product and country, merged to months and countries: next to the exact count, whether the
    estimate lies within five standard errors of it (or one customer)."""
    pay = Build(spark, sf_dir)._stg_payments
    month = F.trunc("order_day", "month").alias("order_month")
    days = sketches.customer_sketches(pay, ["order_day", "product", "country"])
    about = sketches.estimated(sketches.merged(days, [month, "country"]), "about")
    exact = pay.groupBy(month, "country").agg(F.countDistinct("customer_id").alias("active_customers"))
    same = F.col("a.order_month").eqNullSafe(F.col("e.order_month")) & F.col("a.country").eqNullSafe(F.col("e.country"))
    off = F.abs(F.col("about") - F.col("active_customers"))
    return exact.alias("e").join(about.alias("a"), same).select(
        "e.order_month", "e.country", "active_customers",
        (off <= F.greatest(F.lit(1.0), 5 * sketches.STANDARD_ERROR * F.col("active_customers"))).alias("within_bound"))


# --- PRJ2: values that do not fit ---------------------------------------------------------------------------
@query("quarantine_payments", with_models(["raw_payments"], """
SELECT payment_id, CASE WHEN k % 13 = 0 THEN 'rejected' ELSE 'good' END AS outcome, CASE WHEN k % 13 = 0 THEN 'created_at' END AS problem_column,
       CASE WHEN k % 13 = 0 THEN 'not a time' END AS reason, CASE WHEN k % 13 = 0 AND k % 2 = 0 THEN created_at WHEN k % 13 <> 0 THEN created_at END AS created_at
FROM (SELECT payment_id, created_at, CAST(payment_id AS BIGINT) AS k FROM raw_payments) n
"""))
def quarantine_payments(spark, sf_dir):
    """Every thirteenth payment lands with a malformed time; the others are loaded, half of the rejected ones are
    repaired and sent through again.  Each row with what became of it."""
    raw = Build(spark, sf_dir).raw_payments
    rows = landing.to_service_rows(raw, "payments")
    k = F.col("payment_id").cast("long")
    bad = rows.withColumn("created_at", F.when(k % 13 == 0, F.concat(F.lit("at "), "created_at")).otherwise(F.col("created_at")))
    bad = bad.withColumns({c: F.lit("run") for c in ("ingestion_ts", "landed")} | {c: F.lit(1) for c in ("page", "pos")})
    path = scratch_path(spark, "quarantine")
    first = quarantine.write_split(bad, path, "payments")
    rejected = quarantine.read_rejected(spark, path, first["run"], "payments")
    good = quarantine.read_good(spark, path, first["run"], "payments").select(
        "payment_id", F.lit("good").alias("outcome"), F.lit(None).cast("string").alias("problem_column"), F.lit(None).cast("string").alias("reason"), "created_at")
    if rejected is None:
        return good
    mend = lambda df: df.withColumn("created_at", F.when(F.col("payment_id").cast("long") % 2 == 0, F.regexp_replace("created_at", "^at ", "")).otherwise(F.col("created_at")))
    again = quarantine.redrive(spark, path, first["run"], "payments", mend)
    repaired = quarantine.read_good(spark, path, again["run"], "payments").select("payment_id", "created_at")
    set_aside = rejected.select("payment_id", F.lit("rejected").alias("outcome"), F.col("_problems")[0]["column"].alias("problem_column"), F.col("_problems")[0]["reason"].alias("reason"))
    return good.unionByName(set_aside.join(repaired, "payment_id", "left"))
