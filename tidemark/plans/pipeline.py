"""End-to-end runs over a warehouse root (any Hadoop path).

Layout: ``<root>/bronze/<entity>/ingestion_date=D/``,
``<root>/raw|staging|gold/<table>/v=<n>/`` and ``<root>/_meta/watermarks``.
Every clock read is the ``as_of`` argument, so a run can be repeated.
Data is always published before its watermark moves.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rules import STALE_DAYS
from tidemark.operators import dml, inplace
from tidemark.operators.publish import current, publish, retain, version_path, versions
from tidemark.operators.quality import require_key
from tidemark.operators.watermark import default_mark, get_watermark, incremental, mark_lit, newer_than, set_watermark
from tidemark.plans import dims, facts, marts, staging
from tidemark.schemas import KEYS, RAW
from tidemark.session import configure
from tidemark.sources.landing import (BRONZE_ORDER, add_lineage, explode_pages, page_problems, read_bronze, read_pages,
                                      run_id, to_raw, updated_since_text, write_bronze)

# Sessions are insert-only on landing; customers and payments are updated.
RAW_MODE = {"customers": "update", "payments": "update", "sessions": "nothing"}
# Rows are sorted by these inside each file (the time indexes of the raw tables).
CLUSTER = {"payments": "created_at", "sessions": "session_start"}


def land(spark: SparkSession, root: str, entity: str, landing_path: str, as_of: dt.datetime,
         initial_mark: dt.datetime | None = None) -> dict:
    """Landed pages newer than the mark -> one bronze run; then advance the mark.

    Without a stored mark the extract starts at ``initial_mark``, by default
    365 days before ``as_of``.
    """
    configure(spark)
    name = f"wm_{entity}"
    mark = get_watermark(spark, root, name, initial_mark or default_mark(as_of))
    pages = read_pages(spark, landing_path, entity)
    bad = page_problems(pages).take(5)
    if bad:
        raise ValueError(f"landed {entity} pages are incomplete: {[r.asDict() for r in bad]}")
    rows = updated_since_text(explode_pages(pages), mark)
    if as_of <= get_watermark(spark, root, f"raw_{entity}", dt.datetime.min) and not rows.isEmpty():
        raise ValueError(f"as_of {as_of} is not after the last run that was applied to raw.{entity}")
    stats = write_bronze(add_lineage(rows, entity, as_of), f"{root}/bronze", entity)
    stats["run_id"] = run_id(as_of)
    stats["ingestion_date"] = as_of.date()
    if stats["rows"]:
        # next_mark's rule on the max observed by the write: never below the
        # old mark, plus one microsecond (the source filter is >=).
        set_watermark(spark, root, name, max(stats["max_ts"], mark) + dt.timedelta(microseconds=1))
    return stats


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def upsert_raw(spark: SparkSession, root: str, entity: str, batch: DataFrame) -> tuple[str, dict]:
    """Upsert a typed batch (with arrival order columns) into raw.<entity>; new version."""
    target = current(spark, f"{root}/raw", entity, RAW[entity]) or empty(spark, RAW[entity])
    batch = require_key(batch, KEYS[entity])
    out = dml.upsert(target, batch, KEYS[entity], on_match=RAW_MODE[entity], order=BRONZE_ORDER,
                     revive="is_deleted" if entity == "customers" else None)
    obs = Observation(f"raw_{entity}")
    out = out.observe(obs, F.count(F.lit(1)).alias("table_rows"))
    path = publish(out, f"{root}/raw", entity, cluster_by=CLUSTER.get(entity))
    return path, dict(obs.get)


def raw_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/raw/{entity}"


def read_raw(spark: SparkSession, root: str, entity: str, in_place: bool = False) -> DataFrame | None:
    if not in_place:
        return current(spark, f"{root}/raw", entity)
    rows = inplace.read_bucketed(spark, raw_path(root, entity))
    return rows.select(*[f.name for f in RAW[entity].fields]) if rows is not None else None


def upsert_raw_in_place(spark: SparkSession, root: str, entity: str, batch: DataFrame,
                        buckets: int = inplace.DEFAULT_BUCKETS) -> tuple[str, dict]:
    """Large-table form, one commit: sessions append new keys only; customers and payments
    rewrite only the files that may hold a key of the batch."""
    path = raw_path(root, entity)
    key = KEYS[entity]
    batch = require_key(batch, key)
    if RAW_MODE[entity] == "nothing":
        return path, {"appended_rows": inplace.append_new(spark, path, batch, key, order=BRONZE_ORDER, buckets=buckets)}
    opened = inplace.upsert_buckets(spark, path, batch, key, buckets=buckets, order=BRONZE_ORDER,
                                     revive="is_deleted" if entity == "customers" else None)
    return path, {"opened_files": len(opened)}


def soft_delete_raw(spark: SparkSession, root: str, as_of: dt.datetime, in_place: bool = False,
                    days: int = STALE_DAYS, buckets: int = inplace.DEFAULT_BUCKETS) -> dict:
    """Flag customers not seen for ``days`` before ``as_of`` (after every
    customers ingest, rows or not).  Nothing is written when nobody is stale."""
    table = read_raw(spark, root, "customers", in_place)
    if table is None:
        return {"deleted_rows": 0}
    stale = table.where(dml.stale_flag(as_of, days))
    n = stale.count()
    if n == 0:
        return {"deleted_rows": 0}
    if in_place:
        inplace.upsert_buckets(spark, raw_path(root, "customers"), dml.soft_delete(stale, as_of, days),
                               KEYS["customers"], buckets=buckets, order=None)
    else:
        publish(dml.soft_delete(table, as_of, days), f"{root}/raw", "customers")
    return {"deleted_rows": n}


def bronze_batch(spark: SparkSession, root: str, entity: str, since_date: dt.date | None = None,
                 run: str | None = None) -> DataFrame:
    """Typed rows of the landed runs: one run (its date folder only), or all
    runs since a date, or everything."""
    bronze = read_bronze(spark, f"{root}/bronze", entity, since_date)
    if run is not None:
        bronze = bronze.where(F.col("run_id") == run)
    return to_raw(bronze, entity, keep=BRONZE_ORDER)


def bronze_to_raw(spark: SparkSession, root: str, entity: str, since_date: dt.date | None = None,
                  run: str | None = None, in_place: bool = False) -> tuple[str, dict]:
    batch = bronze_batch(spark, root, entity, since_date, run)
    if in_place:
        return upsert_raw_in_place(spark, root, entity, batch)
    return upsert_raw(spark, root, entity, batch)


def apply_bronze(spark: SparkSession, root: str, entity: str, in_place: bool = False) -> tuple[str, dict] | None:
    """Every bronze run not applied yet -> raw, then raw's own mark.

    The mark moves only after raw is published, so a run that stopped in
    between is taken up by the next one; applying a run twice changes nothing.
    """
    name = f"raw_{entity}"
    mark = get_watermark(spark, root, name, dt.datetime(1970, 1, 1))
    bronze = read_bronze(spark, f"{root}/bronze", entity, mark.date())
    bronze = bronze.where(F.to_timestamp_ntz("ingestion_ts") > mark_lit(mark))
    last = bronze.agg(F.max(F.to_timestamp_ntz("ingestion_ts")).alias("m")).first()["m"]
    if last is None:
        return None
    batch = to_raw(bronze, entity, keep=BRONZE_ORDER)
    done = upsert_raw_in_place(spark, root, entity, batch) if in_place else upsert_raw(spark, root, entity, batch)
    set_watermark(spark, root, name, last)
    return done


def read_staging(spark: SparkSession, root: str, name: str, in_place: bool = False) -> DataFrame | None:
    if not in_place:
        return current(spark, f"{root}/staging", name)
    return inplace.read_bucketed(spark, f"{root.rstrip('/')}/staging/{name}")


def read_staging_or_empty(spark: SparkSession, root: str, entity: str, in_place: bool = False) -> DataFrame:
    """The staging table, or an empty one with its schema when nothing landed yet."""
    df = read_staging(spark, root, f"stg_{entity}", in_place)
    return df if df is not None else staging.STAGING[entity](empty(spark, RAW[entity]))


def refresh_staging(spark: SparkSession, root: str, entity: str, full_refresh: bool = False,
                    in_place: bool = False, buckets: int = inplace.DEFAULT_BUCKETS) -> str | None:
    """Incremental staging: rows newer than the staging max, merged on the key.

    Every non-key column is a merge column, so the merge is a keyed replace;
    in place it rewrites only the files that may hold a key of the new rows.
    """
    raw = read_raw(spark, root, entity, in_place)
    name = f"stg_{entity}"
    if raw is None:
        return None   # nothing has landed for this entity yet
    target = None if full_refresh else read_staging(spark, root, name, in_place)
    if in_place and target is not None:
        # the newest time stands in the commit log: no job on the target
        mark = inplace.table(spark, f"{root.rstrip('/')}/staging/{name}").mark("updated_at")
        rows = newer_than(raw, mark, "updated_at")
    else:
        rows = incremental(raw, target, "updated_at")
    new = staging.STAGING[entity](rows)
    if target is not None and new.isEmpty():
        # nothing newer than the staging max: keep the current table as it is
        return f"{root.rstrip('/')}/staging/{name}" if in_place else \
            version_path(f"{root}/staging", name, versions(spark, f"{root}/staging", name)[-1])
    if in_place:
        path = f"{root.rstrip('/')}/staging/{name}"
        if full_refresh:
            inplace.write_bucketed(new, path, KEYS[entity], buckets)
        else:
            inplace.upsert_buckets(spark, path, new, KEYS[entity], buckets=buckets, order=None)
        return path
    out = new if target is None else dml.merge(target, new, KEYS[entity])
    return publish(out, f"{root}/staging", name)


def build_gold(spark: SparkSession, root: str, in_place: bool = False) -> dict[str, str]:
    """Rebuild dimensions, facts and aggregates together (keys stay consistent)."""
    stg_c, stg_p, stg_s = (read_staging_or_empty(spark, root, e, in_place)
                           for e in ("customers", "payments", "sessions"))
    g = f"{root}/gold"
    out = {}
    pm = dims.payment_members(stg_p).checkpoint()     # one pass per table for
    sm = dims.session_members(stg_s).checkpoint()     # all small dimensions
    d = {
        "dim_country": dims.dim_country(stg_c, stg_p, stg_s, pm, sm),
        "dim_customer": dims.dim_customer(stg_c),
        "dim_date": dims.dim_date(stg_p, stg_s, pm, sm),
        "dim_device": dims.dim_device(stg_s, sm),
        "dim_product": dims.dim_product(stg_p, pm),
        "dim_campaign": dims.dim_campaign(stg_s, sm),
    }
    for name, df in d.items():
        out[name] = publish(df, g, name)
    dm = {n: current(spark, g, n) for n in d}
    fp = facts.fact_payments(stg_p, dm["dim_customer"], dm["dim_product"], dm["dim_country"], dm["dim_date"])
    out["fact_payments"] = publish(fp, g, "fact_payments")
    fs = facts.fact_sessions(stg_s, dm["dim_customer"], dm["dim_country"], dm["dim_device"],
                             dm["dim_campaign"], dm["dim_date"])
    out["fact_sessions"] = publish(fs, g, "fact_sessions")
    out["agg_payments_daily"] = publish(marts.agg_payments_daily(current(spark, g, "fact_payments")), g, "agg_payments_daily")
    out["agg_sessions_daily"] = publish(marts.agg_sessions_daily(current(spark, g, "fact_sessions")), g, "agg_sessions_daily")
    out["agg_customer_summary"] = publish(marts.agg_customer_summary(dm["dim_customer"], stg_p, stg_s), g, "agg_customer_summary")
    return out


def run_entity(spark: SparkSession, root: str, entity: str, landing_path: str, as_of: dt.datetime,
               full_refresh: bool = False, initial_mark: dt.datetime | None = None,
               in_place: bool = False) -> dict:
    """One entity's chain: land -> raw (every run not applied yet) -> soft delete
    (customers) -> staging."""
    report: dict = {}
    stats = land(spark, root, entity, landing_path, as_of, initial_mark)
    report[f"land_{entity}"] = stats
    applied = apply_bronze(spark, root, entity, in_place)
    if applied:
        report[f"raw_{entity}"] = applied
    if entity == "customers":
        report["soft_delete_customers"] = soft_delete_raw(spark, root, as_of, in_place)
    report[f"stg_{entity}"] = refresh_staging(spark, root, entity, full_refresh, in_place)
    return report


def run(spark: SparkSession, root: str, landing: dict[str, str], as_of: dt.datetime,
        full_refresh: bool = False, initial_mark: dt.datetime | None = None, in_place: bool = False,
        keep_versions: int | None = None, parallel: bool = False) -> dict:
    """Landing -> bronze -> raw -> staging -> gold for all three entities.

    Only runs not applied to raw yet are read back from bronze (their date folders).
    ``in_place=True`` keeps raw tables bucketed and rewrites only what changes.
    ``parallel=True`` runs the three entity chains at once (independent Spark
    jobs submitted from three driver threads), then gold.
    ``keep_versions`` deletes versioned tables' older versions at the end.
    """
    report: dict = {}
    args = (as_of, full_refresh, initial_mark, in_place)
    if parallel:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=len(landing)) as pool:
            futures = [pool.submit(run_entity, spark, root, e, p, *args) for e, p in landing.items()]
            for f in futures:
                report.update(f.result())
    else:
        for entity, path in landing.items():
            report.update(run_entity(spark, root, entity, path, *args))
    report["gold"] = build_gold(spark, root, in_place)
    if keep_versions:
        report["deleted_versions"] = {
            f"{layer}.{name}": retain(spark, f"{root}/{layer}", name, keep_versions)
            for layer, names in (("raw", [] if in_place else list(KEYS)),
                                 ("staging", [] if in_place else [f"stg_{e}" for e in KEYS]),
                                 ("gold", list(report["gold"])))
            for name in names}
    return report
