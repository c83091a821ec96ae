"""Landed JSON pages -> bronze Parquet -> typed raw rows.

The list service answers in pages ``{page, page_size, total_pages, next_page,
count, data: [row]}``.  Here the pages are files: ``read_envelopes`` reads
every landed page with an explicit schema and explodes ``data`` keeping
(page, pos), the arrival order used for dedup.  ``paginate`` builds the same
envelopes from a table (the list operator); ``filter_resource`` with
``page_slice`` and ``page_totals`` is its filtered single-page form.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rules import PAGE_SIZE_DEFAULT, PAGE_SIZE_MAX, iso_to_ts, ts_to_iso
from tidemark.operators.keys import dense_key_counted
from tidemark.operators.publish import path_exists
from tidemark.operators.watermark import mark_lit, updated_since
from tidemark.schemas import ENTITY_JSON, RAW, bronze, conform, envelope

TIME_FIELDS = {
    "customers": ["signup_date", "updated_at", "last_seen_at"],
    "payments": ["created_at", "updated_at"],
    "sessions": ["session_start", "updated_at"],
}


# --- typed table <-> service rows ------------------------------------------
def to_service_rows(raw: DataFrame, entity: str) -> DataFrame:
    """A typed raw table in the service's JSON shape (ISO text times, double money)."""
    df = raw
    for c in TIME_FIELDS[entity]:
        if c in df.columns:
            df = df.withColumn(c, ts_to_iso(c))
    return conform(df, ENTITY_JSON[entity])


def to_raw(rows: DataFrame, entity: str, keep: list[str] | None = None) -> DataFrame:
    """Service rows (ISO text) -> typed raw columns; ``keep`` extra columns pass through.

    Missing 0/1 flags become 0; a missing ``is_deleted`` is FALSE (column default).
    """
    df = rows
    for c in TIME_FIELDS[entity]:
        if c in df.columns:
            df = df.withColumn(c, iso_to_ts(c))
    if entity == "sessions":
        df = df.withColumns({c: F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in ("bounced", "converted")})
    if entity == "customers":
        df = df.withColumn("is_deleted", F.lit(False))
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
             else F.lit(None).cast(f.dataType).alias(f.name) for f in RAW[entity].fields]
    return df.select(*typed, *(keep or []))


# --- list operator ----------------------------------------------------------
def clamp_page_size(page_size: int | None) -> int:
    return min(int(page_size or PAGE_SIZE_DEFAULT), PAGE_SIZE_MAX)


def updated_since_text(rows: DataFrame, since, fields=("updated_at", "created_at", "session_start")) -> DataFrame:
    """The service's incremental filter on landed text rows: the first
    non-empty of updated_at, created_at, session_start, parsed, ``>= since``."""
    return rows.where(row_time(rows, fields) >= mark_lit(since))


def row_time(rows: DataFrame, fields=("updated_at", "created_at", "session_start")):
    """The time a landed row counts by, in the filter and in the mark."""
    return iso_to_ts(F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in fields if c in rows.columns]))


def filter_resource(df: DataFrame, updated_since_ts=None, equals: dict | None = None) -> DataFrame:
    """Source filters: ``updated_since`` (>=) and column equality (pushed to Parquet)."""
    if updated_since_ts is not None:
        df = updated_since(df, updated_since_ts)
    for c, v in (equals or {}).items():
        df = df.where(F.col(c) == F.lit(v))
    return df


def numbered(df: DataFrame, order_by: str, page_size: int) -> DataFrame:
    """Add ``page`` (1-based) and ``pos`` (0-based) from the rank of ``order_by``
    (a unique column).  Ranking uses the range-partitioned ``dense_key``."""
    return numbered_counted(df, order_by, page_size)[0]


def numbered_counted(df: DataFrame, order_by: str, page_size: int) -> tuple[DataFrame, int]:
    # Rank the key column only: the checkpoint in the shared folder stays
    # narrow, and the rows meet their rank in a shuffle join on the key.
    idx, total = dense_key_counted(df.select(order_by), [order_by], "_idx")
    out = df.join(idx, order_by).select(*df.columns,
                     (F.floor((F.col("_idx") - 1) / page_size) + 1).cast("int").alias("page"),
                     ((F.col("_idx") - 1) % page_size).cast("int").alias("pos"))
    return out, total


def paginate(df: DataFrame, entity: str, order_by: str, page_size: int = PAGE_SIZE_DEFAULT) -> DataFrame:
    """All pages of a list answer, one envelope row per page.

    Each page holds at most ``page_size`` rows (<= 1000), so the per-page
    collect is bounded; pages are built in parallel.
    """
    page_size = clamp_page_size(page_size)
    rows = to_service_rows(df, entity)
    fields = [f.name for f in ENTITY_JSON[entity].fields]
    with_pos, total = numbered_counted(rows, order_by, page_size)
    total_pages = (total + page_size - 1) // page_size
    pages = (with_pos
             .groupBy("page")
             .agg(F.sort_array(F.collect_list(F.struct("pos", F.struct(*fields).alias("row")))).alias("_rows")))
    return pages.select(
        F.col("page").cast("int").alias("page"),
        F.lit(page_size).cast("int").alias("page_size"),
        F.lit(total_pages).cast("int").alias("total_pages"),
        F.when(F.col("page") < total_pages, F.col("page") + 1).cast("int").alias("next_page"),
        F.size("_rows").cast("int").alias("count"),
        F.transform("_rows", lambda x: x["row"]).alias("data"))


def page_slice(df: DataFrame, order_by: str, page: int = 1, page_size: int = PAGE_SIZE_DEFAULT) -> DataFrame:
    """Rows of one page in list order (with their ``pos``)."""
    page_size = clamp_page_size(page_size)
    return numbered(df, order_by, page_size).where(F.col("page") == page)


def page_totals(df: DataFrame, page: int = 1, page_size: int = PAGE_SIZE_DEFAULT) -> DataFrame:
    """Envelope totals for one page request: count, total_pages, next_page."""
    page_size = clamp_page_size(page_size)
    total = F.count(F.lit(1))
    pages = F.floor((total + page_size - 1) / page_size).cast("int")
    return df.agg(
        F.lit(page).cast("int").alias("page"),
        F.lit(page_size).cast("int").alias("page_size"),
        pages.alias("total_pages"),
        F.when(F.lit(page) < pages, F.lit(page + 1)).cast("int").alias("next_page"),
        F.greatest(F.least(total - (page - 1) * page_size, F.lit(page_size)), F.lit(0)).cast("int").alias("count"),
        total.cast("bigint").alias("total"))


def list_resource(df: DataFrame, order_by: str, updated_since_ts=None, equals: dict | None = None,
                  page: int = 1, page_size: int = PAGE_SIZE_DEFAULT) -> tuple[DataFrame, DataFrame]:
    """One list request: filters, then (rows of the page, envelope totals)."""
    filtered = filter_resource(df, updated_since_ts, equals)
    return page_slice(filtered, order_by, page, page_size), page_totals(filtered, page, page_size)


# --- landing files -----------------------------------------------------------
def write_landing(envelopes: DataFrame, path: str) -> None:
    """One JSON page per line (what the extract receives)."""
    envelopes.write.mode("append").json(path)


def read_envelopes(spark: SparkSession, path: str, entity: str, stream: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed pages -> one row per entity with (landed, page, pos), the arrival
    order; empty pages drop out and a page that cannot be parsed is an error.

    As a stream, ``max_files_per_trigger`` bounds each micro-batch.
    """
    return explode_pages(read_pages(spark, path, entity, stream, max_files_per_trigger))


def read_pages(spark: SparkSession, path: str, entity: str, stream: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed pages with ``landed``, the order key of the folder (one per run) they lie in."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.schema(envelope(entity)).option("mode", "FAILFAST").json(path)
    return pages.select("*", landed_key(F.col("_metadata.file_path")).alias("landed"))


def landed_key(file_path):
    """Text that orders landed folders: the folder's name with its numbers padded (``run=9`` before ``run=10``)."""
    folder = F.regexp_extract(file_path, "([^/]*)/[^/]*$", 1)
    parts = F.regexp_extract_all(folder, F.lit("([0-9]+|[^0-9]+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike("^[0-9]"), F.lpad(x, 20, "0")).otherwise(x)), "")


def page_problems(pages: DataFrame) -> DataFrame:
    """Landed runs whose pages are not exactly 1..total_pages, or hold another number of rows than they say."""
    wrong = (F.col("count") != F.size("data")) | F.col("data").isNull() | F.col("page").isNull()
    return (pages.groupBy("landed")
            .agg(F.countDistinct("page").cast("int").alias("pages"), F.min("page").alias("first"), F.max("page").alias("last"),
                 F.min("total_pages").alias("least"), F.max("total_pages").alias("total_pages"),
                 F.sum(wrong.cast("int")).alias("wrong_pages"))
            .where("wrong_pages > 0 OR first <> 1 OR last <> total_pages OR pages <> total_pages OR least <> total_pages"
                   " OR total_pages IS NULL"))


def explode_pages(pages: DataFrame) -> DataFrame:
    return (pages.select("landed", "page", F.posexplode("data").alias("pos", "row"))
                 .select("row.*", "landed", F.col("page").cast("int").alias("page"), F.col("pos").cast("int").alias("pos")))


def last_seen(updated_at: str = "updated_at", seen: str = "last_seen_at", as_of=None):
    """max(updated_at, last_seen_at or now): ``as_of`` stands for now."""
    now = mark_lit(as_of) if as_of is not None else F.current_timestamp().cast("timestamp_ntz")
    seen_col = iso_to_ts(seen) if seen else F.lit(None).cast("timestamp_ntz")
    return F.greatest(iso_to_ts(updated_at), F.coalesce(seen_col, now))


def run_id(as_of: dt.datetime) -> str:
    return as_of.strftime("%Y%m%dT%H%M%S")


def add_lineage(rows: DataFrame, endpoint: str, as_of: dt.datetime, run: str | None = None) -> DataFrame:
    """Lineage columns fixed once per run; customers also get ``last_seen_at``."""
    out = rows
    if endpoint == "customers":
        seen = "last_seen_at" if "last_seen_at" in rows.columns else None
        out = out.withColumn("last_seen_at", ts_to_iso(last_seen("updated_at", seen, as_of)))
    out = out.withColumns({
        "ingestion_ts": F.lit(as_of.isoformat()),
        "ingestion_date": F.lit(as_of.date().isoformat()).cast("date"),
        "source_endpoint": F.lit(endpoint),
        "run_id": F.lit(run or run_id(as_of)),
    })
    return conform(out, bronze(endpoint))


def write_bronze(landed: DataFrame, root: str, endpoint: str) -> dict:
    """Append one run under ``ingestion_date=``; an empty extract writes nothing.

    Row count and max time come from the write itself (``observe``).
    """
    if landed.isEmpty():
        return {"rows": 0, "max_ts": None}
    obs = Observation(f"bronze_{endpoint}")
    (landed.observe(obs, F.count(F.lit(1)).alias("rows"), F.max(row_time(landed)).alias("max_ts"))
           .write.mode("append").partitionBy("ingestion_date").parquet(f"{root.rstrip('/')}/{endpoint}"))
    return dict(obs.get)


def read_bronze(spark: SparkSession, root: str, endpoint: str, since_date: dt.date | None = None) -> DataFrame:
    """All landed runs of one endpoint; ``since_date`` prunes ingestion_date folders.
    Nothing landed yet reads as an empty table."""
    path = f"{root.rstrip('/')}/{endpoint}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], bronze(endpoint))
    df = spark.read.schema(bronze(endpoint)).parquet(path)
    if since_date is not None:
        df = df.where(F.col("ingestion_date") >= F.lit(since_date.isoformat()).cast("date"))
    return df


# Arrival: the run that took the rows in, the landed folder, the page, the place on it.
BRONZE_ORDER = ["ingestion_ts", "landed", "page", "pos"]
