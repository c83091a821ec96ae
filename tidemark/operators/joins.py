"""Join helpers.

* ``fits`` / ``maybe_broadcast``: a side is broadcast only when its rows and
  bytes were counted; beyond the bound the join is a shuffle join.
* ``left_join_skew_safe``: the shuffled form for a dimension that grows with
  the data, with NULL keys spread and hot keys salted by their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when it holds at most this many bytes (counted).
DEFAULT_BROADCAST_MAX_BYTES = 32 << 20
# Fact rows of one key that a task may get before the key is salted.
DEFAULT_ROWS_PER_TASK = 2_000_000


def broadcast_max_bytes(spark) -> int:
    return int(spark.conf.get("tidemark.broadcast.maxBytes", str(DEFAULT_BROADCAST_MAX_BYTES)))


def row_bytes(df: DataFrame):
    """Size of a row as a column: text by its length, other values as eight bytes, a little for the row."""
    text = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c, t in df.dtypes if t == "string"]
    return sum(text, F.lit(16 + 8 * len(df.columns))).cast("long")


def fits(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when all rows together hold at most ``max_bytes``: one distributed sum, one row per task."""
    limit = broadcast_max_bytes(df.sparkSession) if max_bytes is None else max_bytes
    return (df.agg(F.sum(row_bytes(df)).alias("b")).first()["b"] or 0) <= limit


def maybe_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint only for a side whose size was counted; beyond the bound
    the join stays a shuffle join (AQE may still switch it at run time from
    measured sizes, and splits skewed partitions)."""
    return F.broadcast(df) if fits(df, max_bytes) else df


def left_join_dim(fact: DataFrame, dim: DataFrame, on, max_bytes: int | None = None,
                  check: bool = True) -> DataFrame:
    """Many fact rows to one dimension row; never multiplies the fact.

    ``check=False`` trusts the dimension's own size: a broadcast hint set
    where its size was counted (``plans.dims``), or the planner's file-size
    statistics for a table read from files.
    """
    return fact.join(maybe_broadcast(dim, max_bytes) if check else dim, on, "left")


def hot_keys(df: DataFrame, key: str, rows_per_task: int = DEFAULT_ROWS_PER_TASK,
             fraction: float | None = None, seed: int = 17) -> DataFrame:
    """(key, salts) of the keys estimated from a sample to hold more than
    ``rows_per_task`` rows: one salt for every ``rows_per_task`` of them.

    At most (rows / rows_per_task) keys; the result stays a table.
    """
    if fraction is None:
        fraction = float(df.sparkSession.conf.get("tidemark.hotKeys.sampleFraction", "0.01"))
    sample = df.select(key).where(F.col(key).isNotNull())
    if fraction < 1.0:
        sample = sample.sample(fraction=fraction, seed=seed)
    rows = F.count(F.lit(1)) / fraction
    return (sample.groupBy(key).agg(F.ceil(rows / rows_per_task).cast("int").alias("_salts"))
            .where(F.col("_salts") > 1))


def left_join_skew_safe(fact: DataFrame, dim: DataFrame, key: str, max_bytes: int | None = None,
                        rows_per_task: int | None = None, fraction: float | None = None,
                        spread_by: list[str] | None = None) -> DataFrame:
    """Left join, many fact rows to one dimension row, safe against skew.

    * NULL keys never match, but hash partitioning would send every one of
      them to the same task: each NULL row gets a salt of its own.
    * Keys with more rows than a task should get are salted in proportion to
      their size; only their dimension rows are copied, once per salt.
    The join is on (key, salt), one pass over ``fact``.  When the dimension
    fits the broadcast bound there is no shuffle to skew.
    """
    if fits(dim, max_bytes):
        return fact.join(F.broadcast(dim), key, "left")
    spark = fact.sparkSession
    rows = rows_per_task or int(spark.conf.get("tidemark.join.rowsPerTask", str(DEFAULT_ROWS_PER_TASK)))
    hot = maybe_broadcast(hot_keys(fact, key, rows, fraction).checkpoint())
    row_hash = F.xxhash64(*[F.col(c) for c in (spread_by or fact.columns)])
    salt = F.when(F.col(key).isNull(), row_hash).otherwise(F.pmod(row_hash, F.coalesce("_salts", F.lit(1)).cast("long")))
    f = fact.join(hot, key, "left").withColumn("_salt", salt).drop("_salts")
    d = (dim.join(hot, key, "left")
            .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)).cast("long") - 1))).drop("_salts"))
    return f.join(d, [key, "_salt"], "left").drop("_salt")
