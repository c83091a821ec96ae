"""Operator 11: fill-in-middle transformation with content-defined chunk memoization.

A text's units are runs of ASCII letters and single other characters.  A rolling
hash over ``WINDOW`` code points, computed for a whole batch of texts at once,
cuts each text where the hash ends in zeros, so texts that share a passage share
its chunks wherever the passage stands.  For each chunk a bounded cache holds its
boundary summary: units, whether its first character is a letter, whether its last
is.  The cache is looked up by the chunk's characters themselves, so a hash that
happens to be equal never gives the wrong summary.  Summaries compose: two
chunks side by side have the sum of their units, less one where a run of letters
goes across.  The sums along a text say which chunk holds the unit a cut falls on, and
only that chunk is read again.

Defined cases: null text is an empty text; empty texts, and texts that contain a
marker, stay plain; a null doc_id draws its cut from "1:" alone; repeated rows are
transformed one by one, all alike; an empty table gives an empty result; other columns
are ignored.  A task holds one chunk of rows, or one text where that is longer, and the cache.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import mix64, read, release, seeds

#: Fixed values of the transformation.
UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points under the rolling hash; a power of two.
WINDOW = 16
#: Chunks have this many code points on average, and ``LONGEST`` at most.
USUAL, LONGEST = 128, 2048
#: Characters of cached chunks that a task holds.
CACHE = 8 << 20


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def chunk_starts(cp: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where chunks start in texts laid end to end; ``ends`` are the texts' ends, ascending.

    A chunk ends after a window whose hash falls in the smallest 1/USUAL of all
    values, unless the window before it did too (as in runs of one character)."""
    n = len(cp)
    cut = np.zeros(n + 1, bool)
    if n > WINDOW:
        with np.errstate(over="ignore"):
            mult = seeds(1, 111)[0] | np.uint64(1)
            h, span = mix64(cp.astype(np.uint64) + np.uint64(1)), 1
            while span < WINDOW:  # h[i] covers the span code points up to i
                wide = h.copy()
                wide[span:] += h[:-span] * mult
                h, mult, span = wide, mult * mult, 2 * span
            low = mix64(h) < np.uint64((1 << 64) // USUAL)
        low[1:] &= ~low[:-1].copy()
        cut[1:] = low
    texts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    at = np.flatnonzero(cut)
    # a window that reaches back over a text's start says nothing about that text
    inside = at - texts[np.searchsorted(texts, at, side="right") - 1] >= WINDOW
    starts = np.unique(np.concatenate((texts, at[inside])))
    starts = starts[starts < n]
    size = np.diff(np.concatenate((starts, [n])))
    if len(size) and size.max() > LONGEST:
        more = -(-size // LONGEST)
        first = np.repeat(np.cumsum(more) - more, more)
        starts = np.repeat(starts, more) + (np.arange(int(more.sum())) - first) * LONGEST
    return starts


def is_letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


class Summaries:
    """Boundary summaries of chunks, by their content."""

    def __init__(self, limit: int = CACHE):
        self.limit, self.size = limit, 0
        self.known: dict[str, tuple[int, bool, bool]] = {}
        self.asked = self.read = 0

    def of(self, chunks: list[str]) -> list[tuple[int, bool, bool]]:
        known, out = self.known, []
        self.asked += len(chunks)
        for c in chunks:
            s = known.get(c)
            if s is None:
                s = len(UNIT.findall(c)), is_letter(c[0]), is_letter(c[-1])
                self.read += 1
                self.size += len(c) + 100
                if self.size > self.limit:
                    known.clear()
                    self.size = len(c) + 100
                known[c] = s
            out.append(s)
        return out


def unit_start(chunks: list[str], starts: np.ndarray, before: np.ndarray, joined: np.ndarray, unit: int) -> int:
    """Where unit number ``unit`` starts: the chunk that holds its start is read again."""
    k = int(np.searchsorted(before, unit, side="right")) - 1
    at = unit - int(before[k]) + int(joined[k])
    return int(starts[k]) + next(m.start() for i, m in enumerate(UNIT.finditer(chunks[k])) if i == at)


def transform_text(text: str, draws: tuple[int, int, int, int], chunks: list[str], starts: np.ndarray,
                   found: list[tuple[int, bool, bool]]) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, prefix length, middle length, output) of a text with its chunks and their summaries."""
    units = np.array([s[0] for s in found], np.int64)
    joined = np.zeros(len(found), bool)
    joined[1:] = [a[2] and b[1] for a, b in zip(found, found[1:])]
    own = units - joined  # units that start in the chunk
    n = int(own.sum())
    h1, h2, h3, h4 = draws
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    before = np.cumsum(own) - own
    # chunks in which no unit starts are passed over: their successor has the same sum before it
    some = np.flatnonzero(own)
    place = [len(text) if u == n else unit_start([chunks[k] for k in some], starts[some], before[some], joined[some], u)
             for u in sorted((h1 % (n + 1), h2 % (n + 1)))]
    a, b, c = text[: place[0]], text[place[0] : place[1]], text[place[1] :]
    if h4 % 100 < 20:
        return n, "spm", len(a), len(b), SUFFIX + c + PREFIX + a + MIDDLE + b
    return n, "psm", len(a), len(b), PREFIX + a + SUFFIX + c + MIDDLE + b


def restore(output: str, form: str) -> str:
    """The text that an output was made of; the pieces hold no marker, so the first of each kind is the cut."""
    if form == "plain":
        return output
    head, tail = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    body = output.removeprefix(head)
    one, _, rest = body.partition(tail)
    two, _, middle = rest.partition(MIDDLE)
    return one + middle + two if form == "psm" else two + middle + one


def transform_batch(texts: list[str], draws: list[tuple[int, int, int, int]], cache: Summaries) -> list[tuple]:
    """``transform_text`` of every text, with the chunks of all of them cut at once."""
    joined = "".join(texts)
    ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
    starts = chunk_starts(code_points(joined), ends)
    stops = np.concatenate((starts[1:], [len(joined)]))
    first = np.searchsorted(starts, np.concatenate(([0], ends[:-1])))
    last = np.searchsorted(starts, ends)
    out = []
    for t, d, a, b, end in zip(texts, draws, first.tolist(), last.tolist(), ends.tolist()):
        chunks = [joined[i:j] for i, j in zip(starts[a:b].tolist(), stops[a:b].tolist())] if t else []
        out.append(transform_text(t, d, chunks, starts[a:b] - (end - len(t)), cache.of(chunks)))
    return out


def row_parts(texts: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about ``limit`` bytes of text each (a longer text is its own range)."""
    size = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // limit
    cut = np.flatnonzero(np.diff(part)) + 1
    yield from zip([0, *cut.tolist()], [*cut.tolist(), len(size)])


def transformed(docs: DataFrame, digests: bool = False) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row; with ``digests`` the
    SHA-256 of the output and of the text restored from it, in the place of the output."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select(F.col("`doc_id`").alias("doc_id"), F.coalesce(F.col("`text`"), F.lit("")).alias("text"),
                       F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("`doc_id`").cast("string"), F.lit(""))), 256).alias("draw"))

    def sha(x: str) -> str:
        return hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Summaries()
        for batch in batches:
            for a, b in row_parts(batch.column("text")) if batch.num_rows else ():
                part = batch.slice(a, b - a)
                draws = [tuple(int(h[8 * k : 8 * k + 8], 16) for k in range(4)) for h in part.column("draw").to_pylist()]
                done = transform_batch(part.column("text").to_pylist(), draws, cache)
                cols = {"doc_id": part.column("doc_id"), "n": pa.array([x[0] for x in done], pa.int64()), "form": pa.array([x[1] for x in done], pa.string()),
                        "prefix_chars": pa.array([x[2] for x in done], pa.int64()), "middle_chars": pa.array([x[3] for x in done], pa.int64())}
                if digests:
                    cols["output_sha256"] = pa.array([sha(x[4]) for x in done], pa.string())
                    cols["restored_sha256"] = pa.array([sha(restore(x[4], x[1])) for x in done], pa.string())
                else:
                    cols["output"] = pa.array([x[4] for x in done], pa.string())
                yield pa.RecordBatch.from_pydict(cols)
        release()

    tail = "output_sha256 string, restored_sha256 string" if digests else "output string"
    return rows.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, {tail}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transformed(read(spark, sf_dir, "documents"), digests=True)


ORACLE = r"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS us,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
h AS (SELECT doc_id, t, us, len(us) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
             ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM u),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, coalesce(array_to_string(us[1:a], ''), '') AS pre, coalesce(array_to_string(us[a + 1:b], ''), '') AS mid,
             coalesce(array_to_string(us[b + 1:], ''), '') AS suf FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
