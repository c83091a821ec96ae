"""Operators: upserts and merges, marks, dense keys, skew-safe joins, checks."""

from tidemark.operators.dml import first_in_batch, last_in_batch, merge, soft_delete, upsert
from tidemark.operators.inplace import append_new, upsert_buckets
from tidemark.operators.joins import left_join_dim, left_join_skew_safe, maybe_broadcast
from tidemark.operators.keys import dense_key
from tidemark.operators.publish import current, publish
from tidemark.operators.quality import key_violations
from tidemark.operators.watermark import get_watermark, incremental, next_mark, set_watermark

__all__ = ["append_new", "current", "dense_key", "first_in_batch", "get_watermark", "incremental",
           "key_violations", "last_in_batch", "left_join_dim", "left_join_skew_safe", "maybe_broadcast",
           "merge", "next_mark", "publish", "set_watermark", "soft_delete", "upsert", "upsert_buckets"]
