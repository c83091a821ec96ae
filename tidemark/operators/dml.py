"""Row-changing operators on Parquet tables, expressed as joins and unions.

Parquet has no row updates, so each operator returns the new full table; the
caller publishes it as a new version (``publish``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.schemas import TS

ARRIVAL = ["page", "pos"]


def _ts_lit(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast(TS)


def last_in_batch(batch: DataFrame, key: str, order: list[str] = ARRIVAL) -> DataFrame:
    """Keep the last arrival of each key (rows land one after another, so the
    latest one wins, with no timestamp guard).

    ``max_by`` is combined map-side, so a key holding a large share of the
    batch is reduced in every task before the shuffle.
    """
    row = F.struct(*[F.col(c) for c in batch.columns])
    return (batch.groupBy(key)
            .agg(F.max_by(row, F.struct(*[F.col(c) for c in order])).alias("_r"))
            .select("_r.*"))


def first_in_batch(batch: DataFrame, key: str, order: list[str] = ARRIVAL) -> DataFrame:
    """Keep the first arrival of each key (insert-only semantics)."""
    row = F.struct(*[F.col(c) for c in batch.columns])
    return (batch.groupBy(key)
            .agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("_r"))
            .select("_r.*"))


def upsert(target: DataFrame, batch: DataFrame, key: str, on_match: str = "update",
           order: list[str] | None = ARRIVAL, revive: str | None = None) -> DataFrame:
    """Insert new keys; on a key already present either replace the row
    (``on_match="update"``) or keep it (``"nothing"``).

    The batch is reduced to one row per key first (last arrival for update,
    first for nothing) by ``order``; pass ``order=None`` for a batch already
    unique on the key.  ``revive`` names a boolean column set to FALSE on
    every upserted row (soft-deleted rows come back).

    Update is one full outer join on the key: the batch and the target are
    each computed once.  Insert-only anti-joins the batch with the target's
    keys (a key-only scan) and appends.  For a large target and a small batch use ``inplace``.
    """
    cols = target.columns
    if order is not None:
        batch = (last_in_batch if on_match == "update" else first_in_batch)(batch, key, order)
    if revive:
        batch = batch.withColumn(revive, F.lit(False))
    batch = batch.select(*cols)
    if on_match == "update":
        return _replace_by_key(target, batch, key, [c for c in cols if c != key])
    if on_match == "nothing":
        new = batch.join(target.select(key), key, "left_anti")
        return target.unionByName(new)
    raise ValueError(f"on_match must be 'update' or 'nothing', not {on_match!r}")


def _replace_by_key(target: DataFrame, batch: DataFrame, key: str, update_cols: list[str]) -> DataFrame:
    """Full outer join on the key; a matched row takes ``update_cols`` from the
    batch and keeps the rest; unmatched rows come from their own side.
    Columns keep the target's order."""
    t = target.withColumn("_in_t", F.lit(True))
    b = batch.withColumn("_in_b", F.lit(True))
    j = t.alias("t").join(b.alias("b"), key, "full_outer")
    out = []
    for c in target.columns:
        if c == key:
            out.append(F.col(key))
        elif c in update_cols:
            out.append(F.when(F.col("b._in_b"), F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col("t._in_t"), F.col(f"t.{c}")).otherwise(F.col(f"b.{c}")).alias(c))
    return j.select(*out)


def merge(target: DataFrame, batch: DataFrame, key: str, update_cols: list[str] | None = None) -> DataFrame:
    """Keyed merge: matched rows take ``update_cols`` from the batch and keep
    the other columns; new keys are inserted whole; other target rows stay.

    A key twice in the batch is an error, as in SQL MERGE.  The check is a
    count over the key window, which shares the join's shuffle.
    """
    cols = target.columns
    update_cols = [c for c in cols if c != key] if update_cols is None else list(update_cols)
    b = batch.select(*cols).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    b = b.where(F.assert_true(F.col("_n") == 1, F.lit(f"merge batch has a duplicate {key}")).isNull()).drop("_n")
    return _replace_by_key(target, b, key, update_cols)


def stale_flag(as_of, days: int, seen: str = "last_seen_at", deleted: str = "is_deleted") -> Column:
    """Last seen more than ``days`` before ``as_of`` and still live (NULL seen stays live)."""
    cutoff = _ts_lit(as_of) - F.make_dt_interval(F.lit(days))
    return (F.col(seen) < cutoff) & (F.col(deleted) == F.lit(False))


def soft_delete(df: DataFrame, as_of, days: int = 360, seen: str = "last_seen_at",
                deleted: str = "is_deleted", updated: str = "updated_at",
                observation: Observation | None = None) -> DataFrame:
    """Flag stale live rows deleted and stamp ``updated`` with ``as_of``.

    Pass an ``Observation`` to get the number of flagged rows from the same
    pass that writes the table (``observation.get["deleted_rows"]``).
    """
    stale = stale_flag(as_of, days, seen, deleted)
    out = df.withColumn("_stale", stale)
    out = out.withColumns({
        deleted: F.when(F.col("_stale"), F.lit(True)).otherwise(F.col(deleted)),
        updated: F.when(F.col("_stale"), _ts_lit(as_of)).otherwise(F.col(updated)),
    })
    if observation is not None:
        out = out.observe(observation, F.sum(F.col("_stale").cast("long")).alias("deleted_rows"))
    return out.drop("_stale")
