"""Operator 10: quality classifier, naive Bayes support vectors.

Indicators of byte trigrams and of word-shape bigrams (hashed to ``DIM``
places) are scaled by class log-count ratios counted over all labelled training
rows, then a linear hinge-loss model is fitted by dual coordinate descent on a
bounded sample of them: distinct rows (id and text) in order of their hash, half of
``SAMPLE`` from each class, or all of a class that has fewer and the rest from the other.  The
model is ``DIM`` numbers whatever the input; scoring reads every whole text once.

Defined cases: null or empty text has no indicators and gets the score of the
bias; labels for unknown documents, null labels and null ids are ignored; of repeated or
contradicting labels the larger counts; repeated documents are all counted and scored, and
sampled once; a null id is not held out (as in operator 3); with one class
or no training rows every score is the share of label 1 (0.5 without rows); an empty table gives an empty
result.  Language, source, ids and the labels are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, mix64, read, row_cols, small_side, stage, utf8

DIM = 1 << 17
#: Bound of the rows that the support vectors are fitted on.
SAMPLE = 6000
EPOCHS, PENALTY, BLEND = 12, 5.0, 0.25
_M = np.uint64(DIM - 1)


def _shape_table() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[ord("a") : ord("z") + 1] = 1
    t[ord("A") : ord("Z") + 1] = 2
    t[ord("0") : ord("9") + 1] = 3
    t[128:] = 1
    for i, c in enumerate(b"!#$%&*|<>.,;:-_/\\'\"()"):
        t[c] = 4 + i
    t[list(b" \t\n\r\x0b\x0c")] = 63
    return t


SHAPE = _shape_table()


def features(text) -> np.ndarray:
    """Distinct indicator places of a text."""
    b = utf8(text)
    a = np.frombuffer(b, np.uint8)
    if not len(a):
        return np.empty(0, np.int64)
    found = []
    if len(a) >= 3:
        x = a.astype(np.uint64)
        found.append(mix64(x[:-2] | x[1:-1] << np.uint64(8) | x[2:] << np.uint64(16) | np.uint64(1 << 32)) & _M)
    # words as shapes: first, second and last character class, length class, equal to the word before
    s = SHAPE[a]
    inside = s != 63
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    start, stop = edge[::2], edge[1::2]
    if len(start):
        n = stop - start
        size = np.minimum(n, 3) + (n > 6) + (n > 12) + (n > 24)
        h = np.concatenate(([0], np.cumsum(mix64(a.astype(np.uint64) + np.uint64(257)) >> np.uint64(20))))
        word = (h[stop] - h[start]).astype(np.uint64)
        same = np.concatenate(([False], (word[1:] == word[:-1]) & (n[1:] == n[:-1])))
        shape = (s[start].astype(np.uint64) | s[np.minimum(start + 1, stop - 1)].astype(np.uint64) << np.uint64(6)
                 | s[stop - 1].astype(np.uint64) << np.uint64(12) | size.astype(np.uint64) << np.uint64(18) | same.astype(np.uint64) << np.uint64(24))
        found.append(mix64(shape | np.uint64(2 << 32)) & _M)
        found.append(mix64(mix64(shape[:-1] | np.uint64(3 << 32)) + shape[1:]) & _M)
    return np.unique(np.concatenate(found)).astype(np.int64) if len(a) < 4096 else _distinct(found)


def _distinct(found: list[np.ndarray]) -> np.ndarray:
    mark = np.zeros(DIM, bool)
    for x in found:
        mark[x.astype(np.int64)] = True
    return np.flatnonzero(mark)


def remainder(c: Column, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``."""
    return F.crc32(c.cast("string").cast("binary")) % n


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n = np.zeros((2, DIM), np.int64)
    rows = np.zeros(2, np.int64)
    for pdf in chunks(frames):
        for t, y in zip(pdf["text"], pdf["y"]):
            n[y][features(t)] += 1
            rows[y] += 1
    at = np.flatnonzero(n.any(axis=0))
    yield pd.DataFrame({"place": np.concatenate(([-1], at)), "n0": np.concatenate((rows[:1], n[0][at])),
                        "n1": np.concatenate((rows[1:], n[1][at]))})


def _vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in chunks(frames):
        yield pd.DataFrame({"y": pdf["y"], "x": [features(t).astype(np.int32) for t in pdf["text"]]})


def dual_descent(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, penalty: float = PENALTY,
                 epochs: int = EPOCHS, seed: int = 1) -> tuple[np.ndarray, float]:
    """Linear hinge-loss weights over indicators scaled by ``r``, by dual coordinate descent.

    Rows are scaled to unit length; a constant feature is the bias; the classes weigh alike.
    """
    w, bias = np.zeros(len(r)), 0.0
    alpha = np.zeros(len(rows))
    share = np.array([(y < 0).mean(), (y > 0).mean()])
    top = penalty / (2 * share[(y > 0).astype(int)])
    vals = [r[x] / max(np.sqrt((r[x] ** 2).sum()), 1e-9) for x in rows]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            x, v = rows[i], vals[i]
            g = y[i] * (w[x] @ v + bias) - 1
            new = min(max(alpha[i] - g / (v @ v + 1.0), 0.0), top[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[x] += step * v
                bias += step
                alpha[i] = new
    return w, bias


def shares(distinct: tuple[int, int], sample: int) -> tuple[float, float]:
    """The share of each class's distinct rows that is sampled: half of ``sample`` each, what one class lacks from the other."""
    rare = min(*distinct, sample // 2)
    return tuple(min(1.0, (rare if n <= min(distinct) else sample - rare) / max(n, 1)) for n in distinct)


def _sample(train: DataFrame, sample: int) -> DataFrame:
    """text and y of about ``sample`` distinct rows; repeats are combined before they are shuffled."""
    keyed = train.withColumn("row", F.xxhash64("doc_id", "text"))
    counted = {r["y"]: r["n"] for r in keyed.groupBy("y").agg(F.approx_count_distinct("row", 0.02).alias("n")).collect()}  # two rows
    cuts = [int(x * (1 << 30)) for x in shares((counted.get(0, 0), counted.get(1, 0)), sample)]
    at = F.pmod(F.xxhash64("row"), F.lit(1 << 30))
    return keyed.filter(at < F.when(F.col("y") == 0, cuts[0]).otherwise(cuts[1])).dropDuplicates(["row"]).select("text", "y")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> dict:
    """The model: ``r`` (log-count ratios), ``w`` (weights over places), ``bias`` or a constant ``share``."""
    known = (row_cols(labels, "doc_id", label).filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
             .groupBy("doc_id").agg(F.max((F.col(label) > 0).cast("int")).alias("y")))
    train = row_cols(docs, "doc_id", "text").filter(remainder(F.col("doc_id"), 3) != 1).join(small_side(known, 16), "doc_id")
    counts = (train.select("text", "y").mapInPandas(_counts, "place long, n0 long, n1 long")
              .groupBy("place").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas())  # at most DIM + 1 rows
    rows = counts[counts["place"] < 0][["n0", "n1"]].sum().to_numpy()
    if rows.min() == 0:
        return {"share": float(rows[1] / rows.sum()) if rows.sum() else 0.5}
    n = np.ones((2, DIM))
    at = counts[counts["place"] >= 0]
    n[:, at["place"].to_numpy()] += at[["n0", "n1"]].to_numpy().T
    r = np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum())
    vectors = stage(_sample(train, sample).mapInPandas(_vectors, "y int, x array<int>"), "sample")

    def descend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(frames) or [pd.DataFrame({"y": [], "x": []})])
        xs, ys = [np.asarray(x, np.int64) for x in got["x"]], got["y"].to_numpy() * 2 - 1
        w, bias = dual_descent(xs, ys, r) if len(set(ys)) == 2 else (np.ones(len(r)), 0.0)
        yield pd.DataFrame({"w": [w], "bias": [bias]})

    got = vectors.coalesce(1).mapInPandas(descend, "w array<double>, bias double").first()
    w = np.array(got["w"])
    # the blend of the weights with their mean size keeps plain naive Bayes in play
    w = (1 - BLEND) * np.abs(w).mean() + BLEND * w
    return {"r": r, "w": w, "bias": got["bias"] * BLEND}


def scores(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and the score of every whole text."""
    kind = dict(docs.dtypes)["doc_id"]
    slim = row_cols(docs, "doc_id", "text")
    if "share" in model:
        return slim.select("doc_id", F.lit(model["share"]).alias("score"))
    r, weight, bias = model["r"], model["r"] * model["w"], model["bias"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in chunks(frames):
            out = []
            for t in pdf["text"]:
                x = features(t)
                out.append(weight[x].sum() / max(np.sqrt((r[x] ** 2).sum()), 1e-9) + bias)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": 1 / (1 + np.exp(-4 * np.clip(np.array(out, float), -100, 100)))})

    return slim.mapInPandas(run, f"doc_id {kind}, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = scores(docs, fit(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
