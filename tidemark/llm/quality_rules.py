"""Operator 7: quality rules decided by host.

Every document is measured on its whole text.  Rule failures are added up by
host (map-side combine, so a host with a third of all rows is a few partial
sums), each host's failure rate is shrunk with a beta prior fitted to all hosts
by moments, and the hosts whose shrunk rate is over the limit are joined back.

Defined cases: null or empty text has no words and fails ``short``; a null or
blank host is the host ``''``, judged like others; repeated rows are judged one
by one and all returned; an empty table gives an empty result; columns other
than the id, text and host columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_key, chunks, doc_words, drop_rows, mix64, read, row_cols, seeds, small_side, stage, with_key

#: What counts as a symbol, and white space.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
WINDOW = 5
#: A host is refused when its shrunk failure rate of any rule is over this.
HOST_LIMIT = 0.5
RULES = ("short", "repeats", "symbols", "dup_lines")


def repeated_words(ids: np.ndarray, lens: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text, the words that lie in a ``window``-word window found twice or more in that text."""
    n = len(ids)
    ends = np.cumsum(lens)
    doc = np.repeat(np.arange(len(lens)), lens)
    hits = np.zeros(n + 1, np.int64)
    if n >= window:
        mult = seeds(window + 1, 7)
        key = doc[: n - window + 1].astype(np.uint64) * mult[window]
        for j in range(window):
            key = mix64(key + ids[j : n - window + 1 + j].astype(np.uint64) * mult[j])
        start = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
        key = key[start]
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(start), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(hits, start[twice], 1)
        np.add.at(hits, start[twice] + window, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(hits[:n]) > 0)))
    return inside[ends] - inside[ends - lens]


def _measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in chunks(frames):
        texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
        ids, lens, _ = doc_words(texts)
        lines = [[x for x in t.split("\n") if x.strip(SPACES)] for t in texts]
        yield pd.DataFrame({
            "doc_id": pdf["doc_id"],
            "host": pdf["host"],
            "n_words": lens,
            "word_chars": [len(t) - sum(map(t.count, SPACES)) for t in texts],
            "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
            "n_lines": [len(x) for x in lines],
            "n_dup_lines": [len(x) - len(set(x)) for x in lines],
            "n_repeat_words": repeated_words(ids, lens),
        })


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the counts of every whole text."""
    kind = dict(docs.dtypes)["doc_id"]
    slim = row_cols(docs, "doc_id", "text", host).toDF("doc_id", "text", "host").withColumn("host", host_of(F.col("host")))
    return slim.mapInPandas(_measure, f"doc_id {kind}, host string, n_words long, word_chars long, n_symbols long, "
                                      "n_lines long, n_dup_lines long, n_repeat_words long")


def host_of(c: Column) -> Column:
    """Host of a URL (scheme, user, port, path and a leading ``www.`` dropped), or the name itself, in lower case."""
    bare = F.regexp_replace(F.lower(F.trim(c.cast("string"))), r"^[a-z][a-z0-9+.-]*://", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"[/?#].*$", ""), r"^[^@]*@", "")
    return F.coalesce(F.regexp_replace(F.regexp_replace(bare, r":[0-9]*$", ""), r"^www\.", ""), F.lit(""))


def with_rules(m: DataFrame) -> DataFrame:
    n = F.col("n_words")
    return (m.withColumn("short", n < 10)
            .withColumn("repeats", 100 * F.col("n_repeat_words") > 20 * n)
            .withColumn("symbols", 10 * F.col("n_symbols") > n)
            .withColumn("dup_lines", 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")))


def host_rates(m: DataFrame) -> DataFrame:
    """Per host: its documents and, per rule, failures and the shrunk failure rate.

    The beta prior of a rule has the pooled rate as its mean; its strength comes
    from the spread of the hosts' rates beyond what binomial noise explains
    (strength between 1 and 10,000 documents).
    """
    hosts = m.groupBy("host").agg(F.count("*").alias("n_docs"),
                                  *[F.sum(F.col(r).cast("long")).alias(f"f_{r}") for r in RULES])
    hosts = stage(hosts, "hosts")
    # one row: totals, and sums of n*p*p for the weighted variance of the hosts' rates
    t = hosts.agg(F.sum("n_docs").alias("n"), F.count("*").alias("hosts"),
                  *[F.sum(f"f_{r}").alias(f"f_{r}") for r in RULES],
                  *[F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / F.col("n_docs")).alias(f"pp_{r}") for r in RULES]).first()
    out = hosts
    for r in RULES:
        p, s = beta_prior(t["n"] or 0, t["hosts"], t[f"f_{r}"] or 0, t[f"pp_{r}"] or 0.0)
        out = out.withColumn(f"rate_{r}", (F.col(f"f_{r}") + F.lit(p * s)) / (F.col("n_docs") + F.lit(s)))
    return out.select("host", "n_docs", *[f"f_{r}" for r in RULES], *[f"rate_{r}" for r in RULES])


def beta_prior(n: int, hosts: int, failed: int, pp: float) -> tuple[float, float]:
    """Mean and strength of the prior from all documents, hosts, failures and the sum of failures^2/documents."""
    if not n:
        return 0.0, 10000.0
    p = failed / n
    noise = p * (1 - p)
    between = pp / n - p * p - noise * hosts / n
    return p, max(noise / between - 1, 1.0) if between > noise / 10001 else 10000.0


def quality_rules(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Counts, rule results and the verdict of every document."""
    m = stage(with_rules(measure(docs, host)), "measures")
    bad = F.lit(False)
    for r in RULES:
        bad = bad | (F.col(f"rate_{r}") > limit)
    refused = small_side(host_rates(m).filter(bad).select("host", F.lit(True).alias("host_failed")), row_bytes=512)
    return (m.join(refused, "host", "left")
            .withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
            .withColumn("base_failed", F.col("short") | F.col("repeats"))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_failed")


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules refuse go."""
    rows, key = with_key(docs)
    return drop_rows(rows, key, quality_rules(by_key(rows, key)).filter("NOT kept"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS src FROM documents),
w AS (SELECT doc_id, src, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
win2 AS (SELECT doc_id, i, ws[i:i + 4] AS g FROM win),
dup AS (SELECT doc_id, g FROM win2 GROUP BY doc_id, g HAVING count(*) > 1),
cover AS (SELECT x.doc_id, count(DISTINCT x.i + k.k) AS n FROM win2 x JOIN dup USING (doc_id, g)
          CROSS JOIN (SELECT unnest(range(0, 5)) AS k) k GROUP BY x.doc_id),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM ln
          WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, src, len(ws)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cover USING (doc_id) LEFT JOIN lines USING (doc_id)),
r AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
flags AS (SELECT src, unnest(['short', 'repeats', 'symbols', 'dup_lines']) AS rule,
        unnest([n_words < 10, 100 * n_repeat_words > 20 * n_words, 10 * n_symbols > n_words, 10 * n_dup_lines > 3 * n_lines])::INT AS f FROM m),
host AS (SELECT rule, src, count(*) AS n, sum(f) AS f FROM flags GROUP BY ALL),
prior AS (SELECT rule, sum(f) / sum(n) AS p, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ** 2 AS v,
            count(*) / sum(n) AS per FROM host GROUP BY rule),
strength AS (SELECT rule, p, CASE WHEN v - p * (1 - p) * per > p * (1 - p) / 10001
            THEN greatest(p * (1 - p) / (v - p * (1 - p) * per) - 1, 1) ELSE 10000 END AS s FROM prior),
bad AS (SELECT DISTINCT src FROM host JOIN strength USING (rule) WHERE (f + p * s) / (n + s) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND src NOT IN (SELECT src FROM bad) AS kept, src IN (SELECT src FROM bad) AS host_failed
FROM r
"""
