"""Versioned tables on plain Parquet.

``publish`` writes the whole new table to ``<root>/<name>/v=<n>``; readers take
the highest version that finished (has ``_SUCCESS``), so a half-written
version is never read and the previous one stays for rollback.  A writer claims its
version number first, so that two writers never write one folder.  Works on any
Hadoop file system (HDFS, object stores).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.files import file_system as _fs
from tidemark.operators.files import path_exists, put_if_absent

__all__ = ["path_exists", "versions", "version_path", "publish", "current", "retain", "qualified", "ensure_layers", "ensure_table",
           "table_exists", "register", "LAYERS"]

_V = re.compile(r"^v=(\d+)$")


def versions(spark: SparkSession, root: str, name: str, finished: bool = True) -> list[int]:
    """Versions of a table, ascending: only finished ones (with ``_SUCCESS``)
    unless ``finished=False``."""
    base = f"{root.rstrip('/')}/{name}"
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = _V.match(st.getPath().getName())
        if m and (not finished or fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))):
            out.append(int(m.group(1)))
    return sorted(out)


def version_path(root: str, name: str, v: int) -> str:
    return f"{root.rstrip('/')}/{name}/v={v:06d}"


def claim_version(spark: SparkSession, root: str, name: str) -> int:
    """The next version number, past every attempt, finished or not (a crashed write stays unread), for this writer alone."""
    vs = versions(spark, root, name, finished=False)
    v = vs[-1] + 1 if vs else 1
    while not put_if_absent(spark, f"{root.rstrip('/')}/{name}/_claims/{v:06d}", ""):
        v += 1
    return v


def publish(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None,
            cluster_by: str | None = None) -> str:
    """Write ``df`` as the next version of ``name``; returns its path.

    ``cluster_by`` sorts rows inside each output file by that column (no
    extra shuffle), so Parquet row-group min/max statistics let time-range
    reads skip most of the file -- the role of a time index.
    """
    path = version_path(root, name, claim_version(df.sparkSession, root, name))
    if cluster_by:
        df = df.sortWithinPartitions(cluster_by)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def current(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame | None:
    """The latest finished version, or None when the table was never published."""
    vs = versions(spark, root, name)
    if not vs:
        return None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(version_path(root, name, vs[-1]))


def retain(spark: SparkSession, root: str, name: str, keep: int = 2) -> list[int]:
    """Delete versions older than the last ``keep`` finished ones (crashed
    attempts older than those too).  Returns the deleted version numbers."""
    if keep < 1:
        raise ValueError("keep at least the current version")
    done = versions(spark, root, name)
    if len(done) <= keep:
        return []
    oldest_kept = done[-keep]
    doomed = [v for v in versions(spark, root, name, finished=False) if v < oldest_kept]
    for v in doomed:
        fs, p = _fs(spark, version_path(root, name, v))
        fs.delete(p, True)
    return doomed


LAYERS = ["bronze", "raw", "staging", "gold", "meta"]


def qualified(name: str, custom_schema: str | None, target_schema: str) -> str:
    """Schema routing: a model's own schema name is used as is, else the target's."""
    return f"{(custom_schema or target_schema).strip()}.{name}"


def ensure_layers(spark: SparkSession, root: str, layers: list[str] = LAYERS) -> None:
    """Create the layer databases if missing, each located under ``root``."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root.rstrip('/')}/{layer}'")


def ensure_table(spark: SparkSession, root: str, name: str, schema) -> str:
    """Create an empty typed table (version 1) when the table has no version."""
    vs = versions(spark, root, name)
    if vs:
        return version_path(root, name, vs[-1])
    return publish(spark.createDataFrame([], schema), root, name)


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    return bool(versions(spark, root, name))


def register(spark: SparkSession, root: str, layer: str, name: str) -> None:
    """Point ``layer.name`` in the session catalog at the current version."""
    vs = versions(spark, f"{root.rstrip('/')}/{layer}", name)
    if not vs:
        raise ValueError(f"{layer}.{name} has no published version")
    path = version_path(f"{root.rstrip('/')}/{layer}", name, vs[-1])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root.rstrip('/')}/{layer}'")
    spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
    spark.sql(f"CREATE TABLE {layer}.{name} USING parquet LOCATION '{path}'")
