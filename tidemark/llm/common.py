"""Helpers shared by the operators: words, batches, size-checked broadcast."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stage

__all__ = ["read", "stage", "stage_narrow", "small_side", "utf8", "words", "chunks", "doc_words", "mix64", "row_cols"]

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLD = 0x9E3779B97F4A7C15


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def row_cols(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: others (whatever their names) never clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def small_side(df: DataFrame, row_bytes: int, max_bytes: int = 8 << 20) -> DataFrame:
    """A written table, marked for broadcast when its rows (of at most ``row_bytes``
    each) are proven to fit ``max_bytes``; beyond that it joins by shuffle."""
    df = stage(df, "side")
    return F.broadcast(df) if df.count() * row_bytes <= max_bytes else df


def stage_narrow(df: DataFrame, tag: str) -> DataFrame:
    """``stage`` for rows of a few numbers: an eighth of the shuffle's tasks and files (no further shuffle)."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(df.coalesce(max(8, parts // 8)), tag)


def with_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written with a key of their own (ids may be null or shared), and the key's column."""
    key = "row_key"
    while key in [c.lower() for c in docs.columns]:
        key += "_"
    return stage(docs.withColumn(key, F.monotonically_increasing_id()), "keyed"), key


def by_key(rows: DataFrame, key: str) -> DataFrame:
    """The rows with their key in the place of doc_id, for an operator to report on."""
    return rows.drop("doc_id").withColumnRenamed(key, "doc_id")


def drop_rows(rows: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows, without ``key``, whose key is not a doc_id of ``dropped``; texts are shuffled only where these are proven too many to broadcast."""
    dropped = dropped.select(F.col("doc_id").alias(key)).distinct()
    return rows.join(small_side(dropped, 16, 64 << 20), key, "left_anti").select(*[c for c in rows.columns if c != key])


def utf8(text) -> bytes:
    """UTF-8 of a text; null is empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def words(text) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 (``bytes.split`` parts at exactly these six bytes)."""
    return utf8(text).split()


def chunks(frames: Iterator[pd.DataFrame], column: str = "text", limit: int = 2 << 20) -> Iterator[pd.DataFrame]:
    """Rows in order, cut so that a chunk holds about ``limit`` characters (a longer text is its own chunk)."""
    for pdf in frames:
        if not len(pdf):
            continue
        size = pdf[column].map(lambda t: len(t) if isinstance(t, str) else 0).to_numpy(dtype=np.int64)
        part = (np.cumsum(size) - size) // limit
        for start, stop in zip(*_runs(part)):
            yield pdf.iloc[start:stop].reset_index(drop=True)
        release()


def release() -> None:
    """Hand freed memory back to the system, so that workers kept for later stages stay small."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
    pa.default_memory_pool().release_unused()


def _runs(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.diff(part)) + 1
    return np.concatenate(([0], cut)), np.concatenate((cut, [len(part)]))


def doc_words(texts, lower: bool = False) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(word number of every word, words per text, the distinct words by number)."""
    vocab: dict[bytes, int] = {}
    number = vocab.setdefault
    parts, lens = [], []
    for t in texts:
        b = utf8(t)
        w = (b.lower() if lower else b).split()
        parts.append(np.fromiter((number(x, len(vocab)) for x in w), np.int64, len(w)))
        lens.append(len(w))
    ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return ids, np.array(lens, np.int64), list(vocab)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixing step (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003 % 2**63)) * np.uint64(_GOLD))
