"""Operator 6: uniform shuffle into shards of exact sizes (law ``rows``).

Rows are written once with a number of their own (so equal rows are told apart) and dealt to
source groups by a hash of it.  Every shard is cut into target
blocks of exact sizes.  How many rows go from each group to each block is drawn
from the multivariate hypergeometric law of a uniform permutation (the
communication matrix: groups x blocks, bounded by ``GROUPS`` squared, and drawn
from the groups' counts alone).  Each group is permuted locally and cut by its
matrix row, rows are exchanged by block, and each block is permuted again; a
row's slot is its block's offset plus its place.  The matrix is bounded, so groups and blocks
grow with the input; each is therefore permuted in pieces of about ``PIECE`` rows: a row's
random number names its piece, pieces are sorted alone and the counts of the pieces before are
added.  No window spans a group, a shard or the table.  All row work is DataFrame operations; only counts reach the driver.

Defined cases: null text has size 1 and the checksum of no bytes; null or
repeated ids and repeated rows are placed like others (every row gets its own
slot); an empty table gives an empty result; other columns are ignored.  The result depends on
the rows, how they are cut into tasks when they are written, and the seed.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import read, row_cols, small_side, stage

SHARDS = 8
#: Rows a group or block aims at, and the bound on their number.
AIM, GROUPS = 4096, 1024
#: Rows that one sort aims at.
PIECE = 1 << 20
#: Populations beyond the generator's own range, and the counts up to which rows are drawn one by one.
LARGE, FEW = 10**9, 4096


def block_sizes(rows: int, shards: int, aim: int = AIM, most: int = GROUPS) -> list[tuple[int, int, int]]:
    """(shard, offset in the shard, rows) of every block; shard sizes differ by one at most."""
    per_shard = max(1, min(-(-rows // (aim * shards)), most // shards))
    out = []
    for s in range(shards):
        size = rows // shards + (s < rows % shards)
        edges = [size * k // per_shard for k in range(per_shard + 1)]
        out += [(s, a, b - a) for a, b in zip(edges, edges[1:])]
    return out


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows from each group to each block: row sums ``counts``, column sums ``sizes``, distributed as for a uniform permutation."""
    rng = np.random.default_rng(seed)
    left, out = np.array(sizes, np.int64), []
    for n in counts:
        total, row = int(left.sum()), np.zeros(len(left), np.int64)
        for k in range(len(left)):  # a block after the other, given what the blocks before took
            if n == 0:
                break
            here = int(left[k])
            total -= here
            row[k] = n if total == 0 else (_draw(rng, here, total, n) if here else 0)
            n -= int(row[k])
        left -= row
        out.append(row.tolist())
    return out


def _draw(rng, good: int, bad: int, n: int) -> int:
    """Hypergeometric: how many of ``n`` rows, drawn without replacement, are among the ``good``."""
    total = good + bad
    if total < LARGE:
        return int(rng.hypergeometric(good, bad, n))
    if n > total - n:  # the rows left behind are the fewer
        return good - _draw(rng, good, bad, total - n)
    if good > bad:
        return n - _draw(rng, bad, good, n)
    a, b = min(good, n), max(good, n)  # the law is the same with the two exchanged
    if a <= FEW:
        got = 0
        for k in range(a):
            got += int(rng.integers(total - k)) < b - got
        return got
    return _ratio_of_uniforms(rng, a, b, total)


def _ratio_of_uniforms(rng, a: int, b: int, total: int) -> int:
    """Hypergeometric by rejection from the ratio of two uniforms, the hat as for discrete unimodal laws (Stadlober 1990).

    Logarithms of chances are taken relative to the mode's and by differences, so they keep
    their precision where factorials themselves would lose it.
    """
    mode = (a + 1) * (b + 1) // (total + 2)
    variance = a * (b / total) * ((total - b) / total) * ((total - a) / (total - 1))
    centre = a * b / total + 0.5
    width = 2 * math.sqrt(2 / math.e) * math.sqrt(variance + 0.5) + 3 - 2 * math.sqrt(3 / math.e)
    lowest = max(0, a + b - total)
    while True:
        u, v = 1.0 - rng.random(), rng.random()
        k = math.floor(centre + width * (v - 0.5) / u)
        if lowest <= k <= a and 2 * math.log(u) <= log_chance(k, mode, a, b, total):
            return k


def log_chance(k: int, mode: int, a: int, b: int, total: int) -> float:
    """Logarithm of the chance of ``k`` over that of ``mode``."""
    d = k - mode
    cells = [(mode, d), (a - mode, -d), (b - mode, -d), (total - a - b + mode, d)]
    up, down = (max(cells[0][0], 1) * max(cells[3][0], 1)), (max(cells[1][0], 1) * max(cells[2][0], 1))
    return -math.fsum([d * math.log1p((up - down) / down), *(_growth(x, step) for x, step in cells)])


def _growth(x: int, d: int) -> float:
    """ln((x + d)! / x!) - d ln(max(x, 1))."""
    if min(x, x + d) < 1000:
        return math.lgamma(x + d + 1) - math.lgamma(x + 1) - d * math.log(max(x, 1))
    tail = lambda m: 1 / (12 * m) - 1 / (360 * m**3)
    return (x + d + 0.5) * math.log1p(d / x) - d + tail(x + d) - tail(x)


def uniform_shards(docs: DataFrame, shards: int = SHARDS, seed: int = 0, aim: int = AIM, piece: int = PIECE) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    slim = row_cols(docs, "doc_id", "text").select(
        "doc_id", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("row"))
    slim = stage(slim, "rows")
    rows = slim.count()
    blocks = block_sizes(rows, shards, aim)
    groups = len(blocks)
    pieces = max(1, -(-rows // (groups * piece)))
    key = lambda k: F.xxhash64(F.col("row"), F.col("doc_id"), F.col("text_crc32"), F.lit(f"{seed}:{k}"))
    dealt = slim.withColumn("grp", F.pmod(key("group"), F.lit(groups)).cast("int"))
    have = {r["grp"]: r["n"] for r in dealt.groupBy("grp").agg(F.count("*").alias("n")).collect()}  # at most GROUPS rows
    matrix = communication_matrix([have.get(g, 0) for g in range(groups)], [b[2] for b in blocks], seed)
    # where a group's rows for a block begin
    cuts = spark.createDataFrame([(g, np.cumsum(row).tolist()) for g, row in enumerate(matrix)], "grp int, upto array<long>")
    table = spark.createDataFrame([(k, s, a) for k, (s, a, _) in enumerate(blocks)], "block int, shard int, first long")
    placed = (permuted(dealt, "grp", key("local"), pieces)
              .join(F.broadcast(cuts), "grp")
              .withColumn("block", _first_reaching(F.col("upto"), F.col("place")))
              .select("row", "doc_id", "size", "text_crc32", "block"))
    return (permuted(stage(placed, "placed"), "block", key("block"), pieces)
            .join(F.broadcast(table), "block")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place") - 1).alias("slot")))


def permuted(rows: DataFrame, part: str, key: Column, pieces: int) -> DataFrame:
    """The rows with ``place``: 1, 2, ... in the random order of ``key`` within each ``part``, sorted in ``pieces`` pieces of it."""
    rows = rows.withColumn("sort", key).withColumn("piece", F.floor((F.col("sort") / 2.0**64 + 0.5) * pieces).cast("int"))
    upto = Window.partitionBy(part).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = (rows.groupBy(part, "piece").agg(F.count("*").alias("n"))
              .select(part, "piece", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before")))
    inside = Window.partitionBy(part, "piece").orderBy("sort", "row")
    return (rows.withColumn("place", F.row_number().over(inside)).join(small_side(before, 24), [part, "piece"])
            .withColumn("place", F.col("place") + F.col("before")).drop("sort", "piece", "before"))


def _first_reaching(upto: Column, place: Column) -> Column:
    """Index of the first cumulative count that is at least ``place``."""
    return F.size(F.filter(upto, lambda x: x < place))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniform_shards(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
