"""Incremental landing -> raw as a run-to-end Structured Streaming job.

The file source's checkpoint replaces the stored high-water mark: each landed
page file is read once.  Every micro-batch is upserted into the raw table and
published as a new version; replaying a batch after a failure gives the same
table, because the upsert of the same rows is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import dml, inplace
from tidemark.operators.publish import current, publish
from tidemark.schemas import KEYS, RAW
from tidemark.session import configure
from tidemark.sources.landing import read_envelopes, to_raw

ORDER = ["_batch", "landed", "page", "pos"]


def run_stream(spark: SparkSession, landing_path: str, entity: str, checkpoint: str,
               table_root: str, on_match: str | None = None, in_place: bool = False,
               buckets: int = 1024, max_files_per_trigger: int | None = None) -> list[int]:
    """Process everything landed so far, then stop (``availableNow``).

    ``in_place=False`` publishes a new version of the whole table per batch;
    ``in_place=True`` commits new keys (insert-only) or rewrites only the files that may hold a
    key of the batch (update) of ``<table_root>/<entity>``.
    ``max_files_per_trigger`` bounds the landed files per micro-batch
    (``availableNow`` then runs several batches).
    Returns the ids of the micro-batches that ran.
    """
    configure(spark)
    key = KEYS[entity]
    mode = on_match or ("nothing" if entity == "sessions" else "update")
    rows = read_envelopes(spark, landing_path, entity, stream=True, max_files_per_trigger=max_files_per_trigger)
    seen: list[int] = []

    def upsert_batch(batch: DataFrame, epoch: int) -> None:
        typed = to_raw(batch.withColumn("_batch", F.lit(epoch)), entity, keep=ORDER)
        if in_place:
            path = f"{table_root.rstrip('/')}/{entity}"
            if mode == "nothing":
                inplace.append_new(spark, path, typed, key, order=ORDER, buckets=buckets)
            else:
                inplace.upsert_buckets(spark, path, typed, key, buckets=buckets, order=ORDER,
                                       revive="is_deleted" if entity == "customers" else None)
            seen.append(epoch)
            return
        target = current(spark, table_root, entity, RAW[entity])
        if target is None:
            target = spark.createDataFrame([], RAW[entity])
        out = dml.upsert(target, typed, key, on_match=mode, order=ORDER,
                         revive="is_deleted" if entity == "customers" else None)
        publish(out, table_root, entity)
        seen.append(epoch)

    q = (rows.writeStream
             .foreachBatch(upsert_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    q.awaitTermination()
    return seen
