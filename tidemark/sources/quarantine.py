"""Landed rows with values that do not fit: set aside with a reason, while the load goes on.

``to_raw`` fails a load on a malformed time.  ``typed_or_problem`` casts every field without failing and lists
what could not be cast; ``write_split`` writes good and rejected rows in one pass, into two folders of
one write, and reports the counts of that pass.  Rejected rows keep their landed values, the column and the
reason, so that they can be repaired and sent through again (``redrive``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.files import list_names
from tidemark.schemas import ENTITY_JSON, KEYS, RAW
from tidemark.sources.landing import BRONZE_ORDER, TIME_FIELDS

PROBLEMS, REJECTED = "_problems", "_rejected"
#: Bounds of money columns, in whole units: sixteen digits before the point.
MONEY_LIMIT = 1e16
REQUIRED = {"customers": ["customer_id", "updated_at"], "payments": ["payment_id", "created_at", "updated_at"], "sessions": ["session_id", "session_start"]}


def _problem(column: str, reason: str, value: Column) -> Column:
    return F.struct(F.lit(column).alias("column"), F.lit(reason).alias("reason"), value.cast("string").alias("value"))


def typed_or_problem(rows: DataFrame, entity: str, keep: list[str] | None = None) -> DataFrame:
    """Raw columns of landed rows, the landed row itself (``_landed``) and an array ``_problems``.

    A value that cannot be cast becomes NULL and a problem; a required column (key, main times) that is NULL or
    blank is one too.  Blank times count as missing, as in ``to_raw``; missing 0/1 flags are 0."""
    times, typed, problems = set(TIME_FIELDS[entity]), [], []
    for f in RAW[entity].fields:
        if f.name == "is_deleted":
            typed.append(F.lit(False).alias(f.name))
            continue
        landed = F.col(f.name) if f.name in rows.columns else F.lit(None).cast("string")
        if f.name in times:
            text = F.nullif(landed, F.lit(""))
            value = F.try_to_timestamp(text).cast(f.dataType)
            problems.append(F.when(text.isNotNull() & value.isNull(), _problem(f.name, "not a time", landed)))
        elif isinstance(f.dataType, T.DecimalType):
            fits = landed.isNotNull() & ~F.isnan(landed) & (F.abs(landed) < F.lit(MONEY_LIMIT))
            value = F.when(fits, landed).try_cast(f.dataType)
            problems.append(F.when(landed.isNotNull() & ~fits, _problem(f.name, "not an amount", landed)))
        else:
            value = landed.cast(f.dataType)
            if entity == "sessions" and f.name in ("bounced", "converted"):
                problems.append(F.when(landed.isNotNull() & ~landed.isin(0, 1), _problem(f.name, "not 0 or 1", landed)))
                value = F.coalesce(value, F.lit(0))
        if f.name in REQUIRED[entity]:
            blank = landed.isNull() | (landed.cast("string") == "")
            problems.append(F.when(blank, _problem(f.name, "missing", landed)))
        typed.append(value.alias(f.name))
    landed_row = F.struct(*[F.col(f.name) for f in ENTITY_JSON[entity].fields if f.name in rows.columns]).alias("_landed")
    found = F.filter(F.array(*problems), lambda p: p.isNotNull()).alias(PROBLEMS)
    return rows.select(*typed, *(keep or []), landed_row, found)


def write_split(rows: DataFrame, path: str, entity: str, keep: list[str] | None = BRONZE_ORDER) -> dict:
    """Writes landed rows as ``<path>/run=<id>/_rejected=false|true`` in one pass; returns run, rows, good and rejected."""
    run = uuid.uuid4().hex
    checked = typed_or_problem(rows, entity, keep).withColumn(REJECTED, F.size(PROBLEMS) > 0)
    obs = Observation("split")
    bad = F.col(REJECTED).cast("long")
    checked = checked.observe(obs, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(1 - bad), F.lit(0)).alias("good"),
                              F.coalesce(F.sum(bad), F.lit(0)).alias("rejected"))
    slim = F.when(F.col(REJECTED), F.col("_landed")).alias("_landed")          # good rows need no second copy
    (checked.select(*[c for c in checked.columns if c not in ("_landed", REJECTED)], slim, REJECTED)
        .write.partitionBy(REJECTED).parquet(f"{path.rstrip('/')}/run={run}"))
    return {"run": run, **{k: int(v) for k, v in obs.get.items()}}


def _read(spark: SparkSession, path: str, run: str, rejected: bool) -> DataFrame | None:
    folder = f"{path.rstrip('/')}/run={run}/{REJECTED}={str(rejected).lower()}"
    return spark.read.parquet(folder) if list_names(spark, folder) else None


def read_good(spark: SparkSession, path: str, run: str, entity: str, keep: list[str] | None = BRONZE_ORDER) -> DataFrame:
    """Typed rows of a run that passed, with the order columns."""
    df = _read(spark, path, run, False)
    cols = [f.name for f in RAW[entity].fields] + (keep or [])
    if df is not None:
        return df.select(*cols)
    return spark.createDataFrame([], T.StructType(list(RAW[entity].fields) + [T.StructField(c, T.IntegerType() if c in ("page", "pos") else T.StringType()) for c in keep or []]))


def read_rejected(spark: SparkSession, path: str, run: str, entity: str, keep: list[str] | None = BRONZE_ORDER) -> DataFrame | None:
    """Landed values of the rows that were set aside, with their order columns and problems; None where there are none."""
    df = _read(spark, path, run, True)
    return df.select("_landed.*", *(keep or []), PROBLEMS) if df is not None else None


def problem_counts(spark: SparkSession, path: str, run: str, entity: str) -> DataFrame:
    """Rejected rows per column and reason."""
    df = read_rejected(spark, path, run, entity)
    if df is None:
        return spark.createDataFrame([], "column string, reason string, n long")
    return df.select(F.explode(PROBLEMS).alias("p")).groupBy("p.column", "p.reason").agg(F.count(F.lit(1)).alias("n"))


def redrive(spark: SparkSession, path: str, run: str, entity: str, repair: Callable[[DataFrame], DataFrame],
            keep: list[str] | None = BRONZE_ORDER) -> dict | None:
    """Sends a run's rejected rows through again after ``repair``; a new run, whose own rejects may be sent again.

    The rows keep their order columns, so they take the place in the arrival order that they had."""
    rows = read_rejected(spark, path, run, entity, keep)
    return None if rows is None else write_split(repair(rows).drop(PROBLEMS), path, entity, keep)
