"""High-water marks: stored per name, advanced after the data is published."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.publish import current, publish
from tidemark.schemas import TS

DEFAULT_LOOKBACK_DAYS = 365


def default_mark(as_of: dt.datetime) -> dt.datetime:
    return as_of - dt.timedelta(days=DEFAULT_LOOKBACK_DAYS)


def _marks_root(root: str) -> str:
    return f"{root.rstrip('/')}/_meta/watermarks"


def get_watermark(spark: SparkSession, root: str, name: str, default: dt.datetime) -> dt.datetime:
    """The last stored mark, else ``default`` (first run)."""
    df = current(spark, _marks_root(root), name)
    if df is None:
        return default
    row = df.agg(F.max("value").alias("v")).first()
    return row["v"] if row and row["v"] is not None else default


def set_watermark(spark: SparkSession, root: str, name: str, value: dt.datetime) -> None:
    """Store a new mark (call only after the data it covers is published).

    Each mark is a new one-row version: a crash while writing leaves the
    previous mark readable.
    """
    df = spark.createDataFrame([(name, value.isoformat(sep=" "))], "name string, value string")
    publish(df.select("name", F.col("value").cast(TS).alias("value")).coalesce(1), _marks_root(root), name)


def mark_lit(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast(TS)


def next_mark(ts: str | Column, old) -> Column:
    """Aggregate: the next mark after a batch.

    max(ts) never below the old mark, plus one microsecond because the source
    filter is ``>=``; an empty batch leaves the old mark unchanged.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    mx = F.max(c)
    old = mark_lit(old)
    return F.when(mx.isNull(), old).otherwise(
        F.greatest(mx, old) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0.000001)))


def updated_since(df: DataFrame, since, ts_cols=("updated_at", "created_at", "session_start")) -> DataFrame:
    """Source-side incremental filter: first non-empty time >= ``since``.

    When the first column is never NULL the predicate on it alone is what
    reaches the Parquet scan; the coalesce keeps rows whose time is missing.
    """
    present = [c for c in ts_cols if c in df.columns]
    first = F.coalesce(*[F.col(c) for c in present]) if len(present) > 1 else F.col(present[0])
    return df.where(first >= mark_lit(since))


def target_mark(target: DataFrame | None, ts: str = "updated_at"):
    """max(ts) of the target as a Python value (None for a missing or empty target)."""
    if target is None:
        return None
    return target.agg(F.max(ts).alias("m")).first()["m"]


def incremental(source: DataFrame, target: DataFrame | None, ts: str = "updated_at") -> DataFrame:
    """Rows of ``source`` newer than the target's newest (strict ``>``).

    The target max is collected first so the predicate is a literal that is
    pushed into the Parquet scan.  A missing or empty target loads everything.
    Rows at or below the mark are skipped (late rows are not picked up).
    """
    return newer_than(source, target_mark(target, ts), ts)


def newer_than(source: DataFrame, mark, ts: str = "updated_at") -> DataFrame:
    """Rows of ``source`` past the mark; all of them without one (a missing or empty target)."""
    return source if mark is None else source.where(F.col(ts) > mark_lit(mark))
