"""Operator 4: near-duplicates by MinHash with tensored banding.

Every text becomes a set of word shingles.  Two small collections of ``SIDE``
half-keys each are made from minhashes (``ROWS`` per half-key); a table key is a
pair of half-keys, one of either collection, so ``SIDE`` squared tables cost
2 * SIDE * ROWS minhashes only.  At a similarity of 0.8 a pair meets in no table
with probability 2 * (1 - 0.8^3)^16 = 2e-5.

Texts with equal sets are one node from the start, so copies never become pairs.
A half-key that only one node has cannot be part of a shared table key and is
dropped before keys are formed.  Within a table key nodes are compared with the
smallest node; then, where a key still holds nodes of different components,
small keys test those pairs, and large keys are settled with pivots and bounds on the
common shingles (see ``settle``).  So every
pair that meets is tested, already connected, or refused by a bound; no key emits all its pairs.
Candidates are confirmed on full sets by exact counts; a node with very many
partners is copied over salts.  Components come from the confirmed links.

Defined cases: null or empty text (no words) has an empty set and is linked with
nothing; fewer words than a shingle form one shingle; a null doc_id takes part
but is never the representative of a group that has an id; repeated rows are all returned,
with one component (all of its rows that carry the smallest id are kept); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_key, chunks, doc_words, drop_rows, mix64, read, row_cols, seeds, small_side, stage, stage_narrow, with_key
from tidemark.llm.components import components

SIDE, ROWS = 16, 3
#: Keys with up to this many nodes test all pairs that are still open; larger keys go on node by node.
SMALL_KEY = 24
#: Nodes of an area that all its others are compared with.
PIVOTS = 4
#: Nodes of an area that a task compares with all its others.
AREA_ROWS = 512
#: Partners of one node that a task may hold.
SALT_ROWS = 256


def shingle_sets(texts, size: int) -> list[np.ndarray]:
    """Per text its sorted distinct shingles as 64-bit hashes (ASCII letters in lower case)."""
    ids, lens, vocab = doc_words(texts, lower=True)
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, vocab), np.uint64, len(vocab))[ids]
    mult = seeds(size + 1, 4)

    def chain(parts: list[np.ndarray]) -> np.ndarray:
        h = np.full(len(parts[0]), np.uint64(len(parts)), np.uint64)
        for j, x in enumerate(parts):
            h = mix64(h * mult[size] + x * mult[j])
        return h

    full = chain([word[j : len(word) - size + 1 + j] for j in range(size)]) if len(word) >= size else np.empty(0, np.uint64)
    out, at = [], 0
    for n in lens.tolist():
        if n >= size:
            out.append(np.unique(full[at : at + n - size + 1]))
        else:
            out.append(chain([word[at + j : at + j + 1] for j in range(n)]) if n else np.empty(0, np.uint64))
        at += n
    return out


def half_keys(shingles: np.ndarray, side: int = SIDE, rows: int = ROWS) -> np.ndarray:
    """The two collections: 2 * side half-keys of ``rows`` minhashes each."""
    k = 2 * side * rows
    flip, mult = seeds(k, 11)[:, None], (seeds(k, 12) | np.uint64(1))[:, None]
    low = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        low = np.minimum(low, ((shingles[None, at : at + 4096] ^ flip) * mult).min(axis=1))
    low = low.reshape(2 * side, rows)
    key = np.arange(2 * side, dtype=np.uint64)
    for j in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + low[:, j])
    return key.view(np.int64)


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, node (hash of the whole set, null for an empty one) and its half-keys."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in chunks(frames):
            sets = shingle_sets(pdf["text"], size)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_shingles": [len(s) for s in sets],
                                "node": pd.array([node_of(s) if len(s) else None for s in sets], dtype="Int64"),
                                "half": [half_keys(s) if len(s) else None for s in sets]})

    return row_cols(docs, "doc_id", "text").mapInPandas(run, f"doc_id {kind}, n_shingles long, node long, half array<long>")


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """node and its set."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in chunks(frames):
            sets = shingle_sets(pdf["text"], size)
            yield pd.DataFrame({"node": [node_of(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]})

    return docs.select("text").mapInPandas(run, "node long, shingles array<long>")


def table_keys(nodes: DataFrame) -> DataFrame:
    """(key, node, a) of the table keys that may be shared: both half-keys are had by another node too; ``a`` is the
    first half-key."""
    half = nodes.select("node", F.posexplode("half").alias("i", "h"))
    shared = half.groupBy("i", "h").agg(F.count("*").alias("n")).filter("n > 1").select("i", "h")
    live = (half.join(shared, ["i", "h"]).groupBy("node")
            .agg(F.collect_list(F.when(F.col("i") < SIDE, F.struct("i", "h"))).alias("a"),
                 F.collect_list(F.when(F.col("i") >= SIDE, F.struct("i", "h"))).alias("b")))  # at most SIDE each
    pairs = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.struct(
        F.xxhash64(x["i"], x["h"], y["i"], y["h"]).alias("key"), F.xxhash64(x["i"], x["h"]).alias("a")))))
    return live.select("node", F.explode(pairs).alias("k")).select("k.key", "node", "k.a")


class Finder:
    """Confirms candidate pairs on full sets, each once."""

    def __init__(self, sets: DataFrame, nodes: DataFrame, percent: int):
        self.sets, self.percent = sets, percent
        self.size = small_side(nodes.select("node", F.col("n_shingles").alias("n")), 16)
        self.tested: DataFrame | None = None

    def passes(self, most: Column) -> Column:
        """Whether a pair with ``most`` shingles in common at most can reach the threshold."""
        return (100 + self.percent) * most >= self.percent * (F.col("nx") + F.col("ny"))

    def measure(self, pairs: DataFrame) -> DataFrame:
        """(x, y, nx, ny, common) of the ``pairs(x, y)``, x below y, not measured before; written."""
        pairs = (pairs.distinct().join(self.size.toDF("x", "nx"), "x").join(self.size.toDF("y", "ny"), "y")
                 .filter(self.passes(F.least("nx", "ny"))))
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["x", "y"], "left_anti")
        pairs = stage_narrow(pairs, "pairs")
        rows = pairs.count()
        self.tested = pairs.select("x", "y") if self.tested is None else self.tested.union(pairs.select("x", "y"))
        few = F.broadcast if rows * 40 <= 16 << 20 else lambda df: df
        # a node with many partners is copied, so that a task holds SALT_ROWS of them
        salts = pairs.groupBy("x").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts"))
        right = pairs.join(salts, "x").withColumn("salt", F.pmod(F.xxhash64("y"), F.col("salts")).cast("int"))
        right = self.sets.toDF("y", "sy").join(few(right), "y")
        left = self.sets.toDF("x", "sx").join(few(salts), "x").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        both = right.join(left, ["x", "salt"]).withColumn("common", F.size(F.array_intersect("sx", "sy")))
        return stage(both.select("x", "y", "nx", "ny", "common"), "measured")

    def links(self, measured: DataFrame) -> DataFrame:
        return measured.filter(self.passes(F.col("common"))).select("x", "y")


def area_counts(sets: DataFrame, nodes: DataFrame, pivots: DataFrame | None) -> DataFrame:
    """Per node of ``nodes(node, label, area)``: ``s``, its shingles that are in another component of the area too; and
    per pivot k of the area ``i{k}``, its shingles that the pivot has, and ``r{k}``, those of s that the pivot has not."""
    rows = sets.join(nodes.select("node", "label", "area"), "node").select("node", "label", "area", F.explode("shingles").alias("g"))
    if pivots is not None:
        mask = pivots.select(F.col("c").alias("node"), F.expr("shiftleft(1, k)").alias("mask"))
        rows = rows.join(small_side(mask, 24), "node", "left").withColumn("mask", F.coalesce("mask", F.lit(0)))
    else:
        rows = rows.withColumn("mask", F.lit(0))
    known = rows.groupBy("area", "g").agg((F.min("label") < F.max("label")).alias("shared"), F.bit_or("mask").alias("has"))
    known = known.filter("shared OR has <> 0")
    one = [F.sum(F.col("shared").cast("long")).alias("s")]
    for k in range(PIVOTS if pivots is not None else 0):
        inside = F.col("has").bitwiseAND(1 << k) != 0
        one += [F.sum(inside.cast("long")).alias(f"i{k}"), F.sum((F.col("shared") & ~inside).cast("long")).alias(f"r{k}")]
    return rows.drop("mask").join(known, ["area", "g"]).groupBy("node").agg(*one)


def relabel(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (node, label) after further links between components."""
    if labels is None:
        return stage_narrow(components(links), "labels")
    if not links.head(1):
        return labels
    name = lambda c: F.coalesce(F.col(c), F.col(c[1]))
    ends = (links.join(labels.toDF("x", "lx"), "x", "left").join(labels.toDF("y", "ly"), "y", "left")
            .select("x", "y", name("lx").alias("lx"), name("ly").alias("ly")))
    merged = stage_narrow(components(ends.select(F.col("lx").alias("x"), F.col("ly").alias("y"))), "merged")
    fresh = ends.select(F.explode(F.array(F.struct(F.col("x").alias("node"), F.col("lx").alias("label")),
                                          F.struct(F.col("y").alias("node"), F.col("ly").alias("label")))).alias("e")).select("e.*")
    every = labels.union(fresh).union(merged.select("node", F.col("node").alias("label"))).distinct()
    new = every.join(merged.toDF("label", "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return stage_narrow(new.groupBy("node").agg(F.min("label").alias("label")), "labels")


def link(docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, label) of the nodes that have links."""
    keys = table_keys(nodes)
    low = keys.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first < last")
    members = stage(keys.join(low, "key").select("key", "node", "a", "first"), "members")
    met = members.select("node").distinct().join(nodes.select("node", "doc_id"), "node")
    sets = stage(sets_of(docs, met, size), "sets")
    find = Finder(sets, nodes, percent)
    # one partner for every node: the smallest node it meets in any key
    first = members.filter("first < node").groupBy("node").agg(F.min("first").alias("x")).select("x", F.col("node").alias("y"))
    labels = relabel(None, find.links(find.measure(first)))
    # small keys: all pairs of nodes that are not connected yet
    now = stage(in_open_keys(members, labels), "open")
    few, many = now.filter(F.col("n") <= SMALL_KEY), now.filter(F.col("n") > SMALL_KEY)
    mate = few.select("key", F.col("node").alias("y"), F.col("label").alias("ly"))
    near = few.join(mate, "key").filter("node < y AND label <> ly").select(F.col("node").alias("x"), "y")
    labels = relabel(labels, find.links(find.measure(near)))
    # large keys: by pivots of their areas, first to connect most of an area, then to refuse pairs by bounds
    now = stage(in_open_keys(many, labels), "open")
    if not now.head(1):
        return labels
    # areas: nodes connected by first half-keys of open keys (nodes that share a key share one)
    half = stage_narrow(now.select("a", "node").distinct(), "halves")
    low = half.groupBy("a").agg(F.min("node").alias("x"))
    area = stage_narrow(components(half.join(low, "a").select("x", F.col("node").alias("y"))).toDF("node", "area"), "areas")
    for last in (False, True):
        if now.head(1):
            labels = settle(find, sets, now.select("node").distinct().join(area, "node"), labels, last)
            now = stage(in_open_keys(now, labels), "open") if not last else now
    return labels


def settle(find: Finder, sets: DataFrame, now: DataFrame, labels: DataFrame, last: bool) -> DataFrame:
    """Labels after the nodes of every area (``now(node, area)``) are compared with its pivots and,
    in the last step, all pairs of different components in an area are tested or refused by bounds.

    Two sets have at most those shingles in common that each shares with another component;
    and at most, given a pivot, the smaller of their counts in common with the pivot plus the smaller
    of their shared counts outside it.  Pivots are the nodes with the smallest part of their own.
    """
    nodes = now.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    nodes = stage_narrow(nodes.join(find.size, "node"), "areas")
    counts = stage_narrow(area_counts(sets, nodes, None), "counts")
    alive = stage_narrow(nodes.join(counts, "node").filter(100 * F.col("s") >= find.percent * F.col("n")).drop("s"), "areas")
    # the best of each hash class: four of an area at most
    best = F.max_by(F.struct("node", "n", "label"), F.struct(F.col("s") / F.col("n"), F.col("node")))
    pivots = (alive.join(counts.select("node", "s"), "node").groupBy("area", F.pmod(F.xxhash64("node"), F.lit(PIVOTS)).cast("int").alias("k"))
              .agg(best.alias("p")).select("area", "k", F.col("p.node").alias("c"), F.col("p.n").alias("nc"), F.col("p.label").alias("lc")))
    pivots = stage_narrow(pivots, "pivots")
    alive = stage_narrow(alive.join(area_counts(sets, alive, pivots), "node"), "areas")
    common = F.element_at(F.array(*[F.col(f"i{k}") for k in range(PIVOTS)]), F.col("k") + 1)
    met = (alive.join(pivots, "area").filter("node <> c AND label <> lc").withColumn("common", common)
           .select(F.col("node").alias("x"), F.col("c").alias("y"), F.col("n").alias("nx"), F.col("nc").alias("ny"), "common"))
    labels = relabel(labels, stage_narrow(find.links(met), "links"))
    if not last:
        return labels
    alive = alive.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # an area is spread over salts: one side once, the other copied
    wide = alive.groupBy("area").agg(F.ceil(F.count("*") / AREA_ROWS).cast("int").alias("salts"))
    alive = stage_narrow(alive.join(wide, "area").join(pivots.select(F.col("c").alias("node")), "node", "left_anti"), "areas")
    counts = [f"{a}{k}" for a in "ir" for k in range(PIVOTS)]
    side = lambda c: alive.select("area", "salts", *[F.col(v).alias(f"{v}{c}") for v in ("label", "n", "s", *counts)], F.col("node").alias(c))
    xs = side("x").withColumn("salt", F.pmod(F.xxhash64("x"), F.col("salts")).cast("int")).drop("salts")
    ys = side("y").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    bounds = [F.least(f"i{k}x", f"i{k}y") + F.least(f"r{k}x", f"r{k}y") for k in range(PIVOTS)]
    left = xs.join(ys, ["area", "salt"]).filter((F.col("x") < F.col("y")) & (F.col("labelx") != F.col("labely")) & find.passes(F.least("sx", "sy", *bounds)))
    return relabel(labels, find.links(find.measure(left.select("x", "y"))))


def in_open_keys(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, a, label, n) of the keys that hold nodes of two components or more; of keys with the same nodes, one."""
    now = rows.select("key", "node", "a").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    keys = (now.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.count("*").alias("n"), F.min("node").alias("a"),
                                   F.max("node").alias("b"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("h")).filter("l0 < l1"))
    return now.join(keys.groupBy("n", "a", "b", "h").agg(F.min("key").alias("key")).select("key", "n"), "key")


def sets_of(docs: DataFrame, met: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the nodes in ``met(node, doc_id)``."""
    met = stage_narrow(met, "met")
    ids = small_side(met.select("doc_id").filter("doc_id IS NOT NULL").distinct(), 16, 64 << 20)
    some = docs.join(ids, "doc_id", "left_semi").select("text")
    if met.filter("doc_id IS NULL").head(1):
        some = some.union(docs.filter("doc_id IS NULL").select("text"))
    return full_sets(some, size).dropDuplicates(["node"])


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id, itself included) and kept, for every row."""
    sigs = stage(signatures(docs, size), "signatures")
    nodes = stage(sigs.filter("n_shingles > 0").groupBy("node")
                  .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("half").alias("half")), "nodes")
    labels = link(docs, nodes, size, percent)
    named = nodes.select("node", "doc_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    known = named.join(heads, "label").select("node", "component_id")
    return (sigs.select("doc_id", "n_shingles", "node").join(known, "node", "left")
            .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), size=2)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of every group linked by five-word shingles at 0.8, one row stays:
    that of the smallest doc_id (null last), of equal ids the first by key."""
    rows, key = with_key(docs)
    found = stage_narrow(near_duplicates(by_key(rows, key)).select("doc_id", "component_id", "kept"), "groups")
    members = found.join(found.filter("NOT kept").select("component_id").distinct(), "component_id").select(F.col("doc_id").alias(key), "component_id")
    members = stage_narrow(members.join(row_cols(rows, key, "doc_id"), key)
                           .select("component_id", key, F.struct(F.col("doc_id").isNull(), "doc_id", key).alias("rank")), "members")
    first = members.groupBy("component_id").agg(F.min("rank").alias("first"))
    return drop_rows(rows, key, members.join(first, "component_id").filter("NOT rank <=> first").select(F.col(key).alias("doc_id")))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, ws[i] || chr(10) || coalesce(ws[i + 1], '') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 80 * (nx.n + ny.n - k)),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id AS a, doc_id AS z FROM w UNION SELECT r.a, b.y FROM r JOIN b ON b.x = r.z),
m AS (SELECT a AS doc_id, min(z) AS component_id FROM r GROUP BY a)
SELECT m.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, m.doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""
