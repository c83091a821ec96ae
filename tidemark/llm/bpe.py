"""Operator 5: byte-level BPE encoding and decoding, vectorised, without regex.

Pre-tokenisation runs over a whole chunk of texts at once.  Every code point
gets a class from a table; two look-ahead facts (what follows white space or an
apostrophe) are folded into the class.  A small automaton reads the classes;
its step on a class is a function from state to state, and such functions
compose associatively, so the chunk is cut into equal blocks, each block's
composed function is built for all start states at once, the block functions
are scanned, and all blocks are replayed from their true start states in
lock-step.  Emitted boundaries give slices; each distinct slice is merged once
per worker (a cache bounded by count) and the ids are joined.  Offsets of every
token are kept, decoding gathers token bytes by id.

Defined cases: null text is encoded as empty (no ids); repeated rows are encoded
one by one and all returned; an empty table gives an empty result; other columns
are ignored.  Memory in a task is bounded by a chunk, or by one text where that is longer.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.llm.common import chunks, read, release, row_cols, utf8
from tidemark.llm.fill_middle import row_parts

# Classes of code points, after look-ahead.
LETTER, NUMBER, OTHER, APO1, APO2, APO, BLANK_WORD, BLANK_RUN, SPACE_WORD, SPACE_RUN, CUT = range(11)
# States: what the open slice is.
START, IN_L, IN_N, IN_P, GLUE, IN_S, WANT1, WANT2, LAST, N_STATES = range(10)

#: The code points with the White_Space property.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Merged slices that a worker keeps while a task runs.
CACHE = 300_000


@lru_cache(1)
def class_table() -> np.ndarray:
    """Class of every code point before look-ahead."""
    t = np.full(0x110000, OTHER, np.uint8)
    first = np.array([unicodedata.category(chr(i))[0] for i in range(0x110000)])
    t[first == "L"] = LETTER
    t[first == "N"] = NUMBER
    t[WHITE_SPACE] = SPACE_RUN
    t[32] = BLANK_RUN
    t[39] = APO
    return t


@lru_cache(1)
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, a slice starts here) by class and state.

    ``BLANK_*`` is the space, ``SPACE_*`` other white space; ``*_WORD`` means a
    non-space follows.  ``APO1``/``APO2`` is an apostrophe followed by a
    contraction of one or two letters; it counts only where a slice may start.
    """
    step = np.zeros((CUT + 1, N_STATES), np.uint8)
    cut = np.ones((CUT + 1, N_STATES), bool)
    for s in range(N_STATES):
        for c, run in ((LETTER, IN_L), (NUMBER, IN_N), (OTHER, IN_P), (APO, IN_P), (APO1, IN_P), (APO2, IN_P)):
            step[c, s] = run
            cut[c, s] = s not in (run, GLUE)
        if s not in (IN_P, GLUE):
            step[APO1, s], step[APO2, s] = WANT1, WANT2
        step[BLANK_WORD, s] = GLUE  # the last space of a run belongs to what follows
        step[SPACE_WORD, s] = LAST  # other white space before a word stands alone
        for c in (BLANK_RUN, SPACE_RUN):
            step[c, s] = IN_S
            cut[c, s] = s != IN_S
    step[LETTER, WANT2], cut[LETTER, WANT2] = WANT1, False
    step[LETTER, WANT1], cut[LETTER, WANT1] = LAST, False
    step[CUT, :] = START
    return step, cut


def classes(cp: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Classes with look-ahead; ``ends`` are the positions of the separators between texts."""
    base = class_table()[cp]
    base[ends] = CUT
    nxt = np.empty_like(base)
    nxt[:-1] = base[1:]
    nxt[-1:] = CUT
    white = (base == BLANK_RUN) | (base == SPACE_RUN)
    word = white & (nxt != BLANK_RUN) & (nxt != SPACE_RUN) & (nxt != CUT)
    out = base
    out[word] -= 1  # the *_WORD class is one below its *_RUN class
    apo = np.flatnonzero(base == APO)
    if len(apo):
        pad = np.concatenate((cp, np.zeros(2, cp.dtype)))
        a, b = pad[apo + 1], pad[apo + 2]
        one = np.isin(a, [ord(x) for x in "stmd"])
        two = np.zeros(len(apo), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (a == ord(x)) & (b == ord(y))
        out[apo[one]], out[apo[two]] = APO1, APO2
    return out


def boundaries(cls: np.ndarray) -> np.ndarray:
    """True where a slice starts, by a blocked scan of composed step functions."""
    step, cut = automaton()
    n = len(cls)
    width = max(16, int(n ** 0.5) // 8)
    blocks = -(-n // width)
    grid = np.full(blocks * width, CUT, np.uint8)
    grid[:n] = cls
    grid = np.ascontiguousarray(grid.reshape(blocks, width).T)
    # every block's function: where each of the states ends up
    flat = step.ravel()
    fun = np.tile(np.arange(N_STATES, dtype=np.intp), (blocks, 1))
    for row in grid:
        fun = flat[row.astype(np.intp)[:, None] * N_STATES + fun].astype(np.intp)
    # scan of the functions by doubling: after it, row b is the composition of blocks 0..b
    shift = 1
    while shift < blocks:
        fun[shift:] = np.take_along_axis(fun[shift:], fun[:-shift], axis=1)
        shift *= 2
    state = np.concatenate(([START], fun[:-1, START]))
    out = np.empty((width, blocks), bool)
    cuts = cut.ravel()
    for i, row in enumerate(grid):
        at = row.astype(np.intp) * N_STATES + state
        out[i] = cuts[at]
        state = flat[at].astype(np.intp)
    return out.T.ravel()[:n]


def pretokenize(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """(texts joined by a separator, slice starts and ends in it, as code points)."""
    joined = "\0".join(texts) + "\0"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = np.flatnonzero(boundaries(classes(cp, ends)))
    stops = np.concatenate((starts[1:], [len(cp)]))
    real = np.ones(len(starts), bool)
    real[np.searchsorted(starts, ends)] = False  # the separators themselves
    return joined, starts[real], stops[real]


class Encoder:
    """Ranks of byte strings, with a bounded cache of merged slices."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for k, v in self.ranks.items():
            tokens[v] = k
        self.lens = np.array([len(t) for t in tokens], np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.at = np.cumsum(self.lens) - self.lens
        self.cache: dict[str, tuple[int, ...]] = {}

    def forget(self) -> None:
        """Drop the cache at a task's end; workers live on in other stages."""
        self.cache.clear()
        release()

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Join the adjacent pair of lowest rank, leftmost first, until none is left."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(piece) > 200:
            return self.merge_long(piece)
        none, get = 1 << 60, ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        return tuple(ranks[p] for p in parts)

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same by a heap over a linked list: n log n for very long slices."""
        import heapq

        n, ranks = len(piece), self.ranks
        stop = list(range(1, n + 1))  # end of the part that starts at i; 0 once it was joined
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if not stop[i] or j >= n or stop[j] != end:
                continue
            stop[i], stop[j] = end, 0
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n:
                    e = stop[after[a]]
                    if (r := ranks.get(piece[a:e])) is not None:
                        heapq.heappush(heap, (r, a, e))
        return tuple(ranks[piece[i : stop[i]]] for i in range(n) if stop[i])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per text its ids, and the byte offset at which each token starts."""
        joined, starts, stops = pretokenize(texts)
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        pieces = list(map(joined.__getitem__, map(slice, starts.tolist(), stops.tolist())))
        for s in set(pieces).difference(cache):
            cache[s] = self.merge(s.encode("utf-8", "surrogatepass"))
        found = list(map(cache.__getitem__, pieces))
        counts = list(map(len, found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, sum(counts))
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        per = np.concatenate(([0], np.cumsum(np.array(counts, np.int64))))
        cut = per[np.searchsorted(starts, ends)]
        lens = self.lens[ids]
        out, offsets = [], []
        for a, b in zip(np.concatenate(([0], cut[:-1])).tolist(), cut.tolist()):
            out.append(ids[a:b])
            offsets.append(np.cumsum(lens[a:b]) - lens[a:b])
        return out, offsets

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, gathered by id."""
        lens = self.lens[ids]
        total = int(lens.sum())
        if not total:
            return b""
        first = np.cumsum(lens) - lens
        return self.bytes[np.repeat(self.at[ids] - first, lens) + np.arange(total)].tobytes()


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, byte offsets of the tokens, and the bytes decoded from the ids.

    ``path`` is a rank file that every executor can open (an installed vocabulary)."""
    kind, path = dict(docs.dtypes)["doc_id"], path or default_ranks()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in chunks(frames, limit=1 << 20):
            ids, offsets = enc.encode([t if isinstance(t, str) else "" for t in pdf["text"]])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": [x.astype(np.int32) for x in ids],
                                "offsets": offsets, "decoded": [enc.decode(x) for x in ids]})
        enc.forget()

    return row_cols(docs, "doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, ids array<int>, offsets array<long>, decoded binary")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The digest columns of the encoding, without moving the ids out of the worker."""
    kind, path = dict(docs.dtypes)["doc_id"], path or default_ranks()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in chunks(frames, limit=1 << 20):
            ids, _ = enc.encode([t if isinstance(t, str) else "" for t in pdf["text"]])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": [len(x) for x in ids],
                                "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids],
                                "decoded_sha256": [hashlib.sha256(enc.decode(x)).hexdigest() for x in ids]})
        enc.forget()

    return row_cols(docs, "doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))


def encode_parts(batches: Iterator[pa.RecordBatch], enc: Encoder) -> Iterator[pa.RecordBatch]:
    """Token ids and their digest of every row, a quarter of a megabyte of texts at a time (merging takes some forty times as much)."""
    for batch in batches:
        for a, b in row_parts(batch.column("text"), 1 << 18) if batch.num_rows else ():
            part = batch.slice(a, b - a)
            texts = [t or "" for t in part.column("text").to_pylist()]
            ids, _ = enc.encode(texts)
            for t, x in zip(texts, ids):
                if enc.decode(x) != utf8(t):
                    raise ValueError("decoding does not give the text back")
            lens = [len(x) for x in ids]
            flat = pa.array(np.concatenate(ids).astype(np.int32))
            yield pa.RecordBatch.from_pydict({
                **{c: part.column(c) for c in ("doc_id", "lang", "source")},
                "ids": pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lens]), pa.int32()), flat), "n_tokens": pa.array(lens, pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string())})
        release()


def stage_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document's token ids and their digest, with its lang and source."""
    path, schema = default_ranks(), docs.select("doc_id", "lang", "source").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        yield from encode_parts(batches, enc)
        enc.forget()

    out = schema.add("ids", T.ArrayType(T.IntegerType())).add("n_tokens", T.LongType()).add("ids_sha256", T.StringType())
    return row_cols(docs, "doc_id", "text", "lang", "source").mapInArrow(run, out)
