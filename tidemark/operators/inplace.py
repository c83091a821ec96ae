"""Upserts that rewrite only what changes, for very large targets.

``publish`` rewrites a whole table per version.  Large raw and staging tables are tables with a
commit log (``tablelog``) in hash buckets of their key:

* insert-only (``append_new``) reads just the keys of the files that may hold a key of the batch and
  appends the rows with new keys: nothing is rewritten;
* update (``upsert_buckets``) rewrites only the files that may hold a key of the batch.

Each change is one commit: a reader sees all of it or nothing, and two writers cannot undo each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import dml
from tidemark.operators.tablelog import DEFAULT_BUCKETS, LogTable

#: Columns whose least and greatest value the log keeps, where a table has them.
TRACKED = ["updated_at", "created_at", "session_start"]


def table(spark: SparkSession, path: str, key: str | None = None, buckets: int | None = None, columns: list[str] | None = None) -> LogTable:
    return LogTable(spark, path, key, buckets, tracked=[c for c in TRACKED if c in (columns or [])])


def _columns(batch: DataFrame, order: list[str] | None, columns: list[str] | None) -> list[str]:
    return columns or [c for c in batch.columns if c not in (order or [])]


def append_new(spark: SparkSession, path: str, batch: DataFrame, key: str,
               order: list[str] | None = dml.ARRIVAL, columns: list[str] | None = None,
               buckets: int | None = None) -> int:
    """Insert-only: append first arrivals whose key is not in the table yet; returns the number of rows appended."""
    cols = _columns(batch, order, columns)
    t = table(spark, path, key, buckets, cols)
    return t.insert_new(batch.select(*cols, *(order or [])), order).result


def upsert_buckets(spark: SparkSession, path: str, batch: DataFrame, key: str, buckets: int = DEFAULT_BUCKETS,
                   order: list[str] | None = dml.ARRIVAL, revive: str | None = None,
                   columns: list[str] | None = None, files_per_bucket: int = 1) -> list[str]:
    """Update-or-insert rewriting only the files that may hold a key of the batch; returns their names.

    Choose ``buckets`` so that a bucket is a few GB; another number than the stored one is refused."""
    cols = _columns(batch, order, columns)
    t = table(spark, path, key, buckets, cols)
    return t.upsert(batch.select(*cols, *(order or [])), order, revive, files_per_bucket=files_per_bucket).result


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int = DEFAULT_BUCKETS,
                   files_per_bucket: int = 1) -> None:
    """Replace the whole table, laid out in hash buckets of the key."""
    table(df.sparkSession, path, key, buckets, df.columns).replace(df, files_per_bucket=files_per_bucket)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame | None:
    """The table's last state; None where nothing was committed."""
    return LogTable(spark, path).read()
