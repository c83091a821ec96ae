"""Data checks: key uniqueness and the build's invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that are NULL or appear more than once, with their row count.

    Primary keys are not enforced by Parquet; an empty result is the check.
    One shuffle with partial counts per task.
    """
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) | F.col(key).isNull()))


def require_key(df: DataFrame, key: str) -> DataFrame:
    """The rows, failing the job that reads them where a key is NULL (as a primary key does on load)."""
    return df.where(F.assert_true(F.col(key).isNotNull(), F.lit(f"NULL {key}")).isNull())


def is_key(df: DataFrame, key: str) -> bool:
    return key_violations(df, key).isEmpty()


def dense_keys_ok(df: DataFrame, key: str) -> bool:
    """Keys are exactly 1..n without gaps or repeats."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("d"),
               F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    return r["n"] == 0 or (r["n"] == r["d"] and r["lo"] == 1 and r["hi"] == r["n"])


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Multiset equality (order-insensitive), by two anti-joins of counts."""
    cols = a.columns
    ca = a.groupBy(*cols).count()
    cb = b.select(*cols).groupBy(*cols).count()
    return ca.exceptAll(cb).isEmpty() and cb.exceptAll(ca).isEmpty()
