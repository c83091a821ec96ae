"""Operator 3: language-model scores from a hierarchical Pitman-Yor model.

Every context has a restaurant; a context is the whole word before (before the
first word stands the end of a text), so restaurants grow with the words of the
corpus.  All context restaurants share one parent, the restaurant of words without
context, whose base is uniform over the known words and one unknown word.  Customers are
training tokens; a table of a context is a customer of the parent.  Seating is
sampled by Gibbs (a customer leaves, and sits down again at a table or a new
one), and a text's score is the log10 of its tokens' predictive probabilities,
averaged over samples of the seating.

Spread over Spark: texts are cut into blocks of about ``BLOCK`` tokens; a block
sends every bucket of words its distinct (word, context) pairs with counts and
the texts they occur in (combined before the shuffle, so a word or context that
is a third of all tokens is a few rows).  All customers of a word, and so its
tables in every restaurant, lie in one bucket; restaurants reach over buckets
only through their totals of customers and tables, which are added up between
``ROUNDS`` (every bucket sends those of its contexts by ranges of their keys, and
gets the sums back) and held while the buckets sample.  Buckets hold about ``BUCKET`` tokens each; they are
written as a bucketed table, which no round shuffles again.  Every
bucket sends the blocks partial sums of its words' log probabilities.

Within a sweep every customer of every cell (word in a restaurant) gets up once, in
random order, and sits down again: one by one in cells of up to ``SINGLE`` customers; in
larger ones some get up together and are seated by the law of all their
seats at once (``Cells.together``).  Cells of one customer have one table.  The
discounts are estimated from counts of counts.

Defined cases: null or empty text is one end token; a null doc_id is a training
row; repeated rows all count and are all returned; without training rows every word is unknown
(and has probability one); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, read, release, row_cols, utf8
from tidemark.session import scratch_path

CONTEXTS = 4096  # places, less one, that an array of totals has at least
BLOCK, BUCKET = 500_000, 2_500_000
ROUNDS = (2, 4)  # sweeps of each round; those of the last round after its first one are the samples
SINGLE = 32  # customers of a cell up to which they move one by one
TOGETHER = 32  # customers that get up together; where these open few tables, more do, with as many at new ones
FEW = 6.0  # at new tables that are expected of a larger lot: more than ``TOGETHER`` have a chance below 1e-13 then
NUMBER_BITS = 63  # of a word, its context and its text that are sorted as one number
STRENGTH = 1.0
END = b"\n"  # no word holds a line end
ASCENDING = ("keys", "before", "ctx")  # arrays of unsigned numbers, mostly ascending, that are sent as their differences
ROOT = np.uint64(2**64 - 1)  # stands for the parent among the keys of contexts


def gaps(x: np.ndarray) -> tuple[str, np.ndarray]:
    """The differences of neighbours (modulo the type's range, so of any order), all first bytes before all second ones."""
    return x.dtype.str, np.ascontiguousarray(np.diff(x, prepend=x.dtype.type(0)).view(np.uint8).reshape(len(x), x.itemsize).T)


def ungaps(kind: str, planes: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(kind), dtype=kind)


def pack(x: dict) -> bytes:
    x = {k: gaps(v) if k in ASCENDING else v for k, v in x.items()}
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(x, protocol=5))


def unpack(b: bytes) -> dict:
    x = pickle.loads(zstandard.ZstdDecompressor().decompress(b))
    return {k: ungaps(*v) if k in ASCENDING else v for k, v in x.items()}


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values, ascending; by sorting, which takes a fraction of the time of ``np.unique``'s hash table here."""
    x = np.sort(x)
    first = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=first[1:])
    return x[first]


def small(x: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds the values."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


# ---------------------------------------------------------------- blocks

def block_rows(name: str, texts: list, doc_ids, held: np.ndarray, buckets: int) -> list[tuple[int, str, bytes]]:
    """Rows (bucket, block, data) of one block; bucket -1 - k has the block's documents."""
    vocab: defaultdict[bytes, int] = defaultdict(itertools.count(1).__next__, {END: 0})
    parts, lens = [], []
    for t in texts:
        w = utf8(t).lower().split()
        w.append(END)
        parts.append(np.fromiter(map(vocab.__getitem__, w), np.int32, len(w)))
        lens.append(len(w))
    ids, lens = np.concatenate(parts), np.array(lens, np.int64)
    keys = np.fromiter(map(xxhash.xxh3_64_intdigest, vocab), np.uint64, len(vocab))
    by_key = np.argsort(keys)
    place = np.empty(len(keys), np.int64)
    place[by_key] = np.arange(len(keys))
    context = np.roll(place[ids], 1)  # the word before; an end before the first of a text
    doc = np.repeat(np.arange(len(lens)), lens)
    # words in order of bucket and key; tokens in order of word, context and text
    home = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((keys, home))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    code = rank[ids] * len(keys) + context
    bits = len(lens).bit_length()
    if 2 * len(keys).bit_length() + bits <= NUMBER_BITS:  # word, context and text in one number
        code = np.sort((code << bits) | doc)
        code, doc = code >> bits, code & ((1 << bits) - 1)
    else:
        sort = np.argsort(code, kind="stable")
        code, doc = code[sort], doc[sort]
    head = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    count = np.diff(np.concatenate((head, [len(code)])))
    word, ctx = np.divmod(code[head], len(keys))
    edge = np.searchsorted(home[order], np.arange(buckets + 1))
    pair_edge = np.searchsorted(word, edge)
    token_edge = np.concatenate((head, [len(code)]))[pair_edge]
    flags = np.packbits(held)
    rows = []
    for b in range(buckets):
        p, q = pair_edge[b], pair_edge[b + 1]
        if p == q:
            continue
        before, at = np.unique(ctx[p:q], return_inverse=True)
        rows.append((b, name, pack({
            "keys": keys[order[edge[b] : edge[b + 1]]], "word": small(np.diff(word[p:q] - edge[b], prepend=0)), "before": keys[by_key[before]], "ctx": small(at),
            "count": small(count[p:q]), "doc": small(doc[token_edge[b] : token_edge[b + 1]]), "held": flags, "docs": len(lens)})))
    rows.append((-1 - int(keys[order[0]] % np.uint64(buckets)), name, pack({"doc_id": doc_ids, "held": held, "n": lens})))
    return rows


def to_blocks(docs: DataFrame, buckets: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0  # names that a repeated task gives again

        def flush():
            nonlocal made
            made += 1
            pdf = pd.concat(kept, ignore_index=True)
            rows = block_rows(f"{part}-{made}", list(pdf["text"]), pdf["doc_id"].tolist(), pdf["held"].to_numpy(bool), buckets)
            return pd.DataFrame(rows, columns=["bucket", "block", "data"])

        kept, size = [], 0
        for pdf in chunks(frames):
            kept.append(pdf)
            size += int(pdf["text"].map(lambda t: len(t) if isinstance(t, str) else 1).sum())
            if size >= BLOCK * 6:  # about six characters a token
                yield flush()
                kept, size = [], 0
                release()
        if kept:
            yield flush()
        release()

    return docs.mapInPandas(run, "bucket int, block string, data binary")


# ---------------------------------------------------------------- buckets

def merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket's blocks brought together: its words, pairs and training counts, and where each block's pairs are."""
    bucket = int(pdf["bucket"].iloc[0])
    if bucket < 0:
        return pdf.assign(totals=None)
    blocks = [unpack(x) for x in pdf["data"]]
    keys = distinct(np.concatenate([x["keys"] for x in blocks]))
    before = distinct(np.concatenate([x["before"] for x in blocks]))
    codes = [np.searchsorted(keys, x["keys"])[np.cumsum(x["word"], dtype=np.int64)] * len(before) + np.searchsorted(before, x["before"])[x["ctx"]] for x in blocks]
    pairs = distinct(np.concatenate(codes))
    count = np.zeros(len(pairs), np.int64)
    parts = []
    for name, x, code in zip(pdf["block"], blocks, codes):
        at = np.searchsorted(pairs, code)
        held = np.unpackbits(x["held"], count=x["docs"]).astype(bool)
        train = np.concatenate(([0], np.cumsum(~held[x["doc"]])))
        ends = np.cumsum(x["count"], dtype=np.int64)
        count[at] += train[ends] - train[ends - x["count"]]
        parts.append({"block": name, "step": small(np.diff(at, prepend=0)), "count": x["count"], "doc": x["doc"], "docs": x["docs"]})
    word, ctx = np.divmod(pairs, len(before))
    per_word = np.bincount(word, weights=count, minlength=len(keys))
    types = np.bincount(word[count > 0], minlength=len(keys))
    width = max(CONTEXTS + 1, len(before))
    totals = np.concatenate([
        np.bincount(ctx, weights=count, minlength=width), np.bincount(ctx[count > 0], minlength=width),
        [(per_word > 0).sum(), (count == 1).sum(), (count == 2).sum(), (types == 1).sum(), (types == 2).sum()]])
    release()
    data = {"keys": keys, "before": before, "word": small(np.diff(word, prepend=0)), "ctx": small(ctx), "count": small(count), "parts": parts}
    return pd.DataFrame({"bucket": [bucket], "block": [None], "data": [pack(data)], "totals": [totals]})


def merge_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    """``merge`` with the last five totals and the training tokens; those of the contexts are made from the counts again."""
    out = merge(pdf)
    return out.assign(totals=[None if t is None else [*t[-5:], t[: (len(t) - 5) // 2].sum()] for t in out["totals"]])


class Cells:
    """Words seated in restaurants: customers, table sizes (a column of ``seats`` per cell), and moves in all cells at once."""

    def __init__(self, count: np.ndarray, weight: np.ndarray, discount: float, rng):
        self.count, self.discount, self.rng = count.astype(np.int64), discount, rng
        # a first seating, near the law of all seatings: number of tables, then sizes with its tail, the first table taking the rest
        a = np.maximum(weight, 1e-9)
        fall = (1 + self.count / a) ** (-1 / (1 - discount))
        t = np.where(self.count > 0, np.minimum(1 + rng.poisson(a / discount * (1 - fall**discount)), self.count), 0)
        cols = np.arange(max(int(t.max()) if len(t) else 0, 1) + 1)
        shape = len(t), len(cols)
        tail = np.minimum((1 - rng.random(shape)) ** (-1 / discount), 1 + rng.standard_exponential(shape) / fall[:, None])
        tail = np.minimum(tail, self.count[:, None]) * (cols < t[:, None])
        share = tail * ((self.count - t) / np.maximum(tail.sum(axis=1), 1))[:, None] + (cols < t[:, None])
        sizes = np.where((tail[:, 1:].sum(axis=1) < self.count)[:, None], tail, share).astype(np.int32)
        sizes[:, 0] += (self.count - sizes.sum(axis=1)).astype(np.int32)
        self.seats = np.ascontiguousarray(sizes.T)
        # customers that draw others to their table, for each chance of a new table
        self.drawn = (1 - discount * t / np.maximum(self.count, 1)) / np.maximum(weight, 1e-9)

    @property
    def sizes(self) -> np.ndarray:
        """Table sizes, a row per cell."""
        return self.seats.T

    def tables(self) -> np.ndarray:
        return (self.seats > 0).sum(axis=0)

    def own(self, rows: np.ndarray) -> np.ndarray:
        """Table sizes of the (ascending) cells, a column per cell."""
        return self.seats if len(rows) == len(self.count) else np.take(self.seats, rows, axis=1)

    def change(self, rows: np.ndarray, k: np.ndarray, by: int) -> np.ndarray:
        """The new sizes of tables ``k`` of the cells."""
        flat, at = self.seats.reshape(-1), k * len(self.count) + rows
        now = flat[at] + by
        flat[at] = now
        self.count[rows] += by
        return now

    def leave(self, rows: np.ndarray) -> np.ndarray:
        """A random customer of each of the cells gets up; True where the table closes."""
        seat = np.floor(self.rng.random(len(rows)) * self.count[rows]).astype(np.int64)
        k = (running(self.own(rows), np.int64) <= seat).sum(axis=0)
        return self.change(rows, k, -1) == 0

    def sit(self, rows: np.ndarray, weight: np.ndarray | float) -> np.ndarray:
        """A customer sits down in each of the cells; ``weight`` is that of a new table; True where one opens."""
        own = self.own(rows)
        upto = running(np.where(own > 0, own - self.discount, 0.0), np.float64)
        draw = self.rng.random(len(rows)) * (upto[-1] + weight)
        fresh = draw >= upto[-1]
        k = np.minimum((upto <= draw).sum(axis=0), len(own) - 1)
        opens = np.flatnonzero(fresh)
        free = own[:, opens] == 0
        k[opens] = free.argmax(axis=0)
        full = (free.sum(axis=0) == 1).any()
        self.change(rows, k, 1)
        if full:
            self.add_columns()
        return fresh

    def add_columns(self) -> None:
        self.seats = np.pad(self.seats, ((0, max(4, len(self.seats) // 2)), (0, 0)))

    def lots(self, rows: np.ndarray) -> np.ndarray:
        """How many customers of each of the cells get up at a time: a power of two, by counts and the first seating alone."""
        count = self.count[rows]
        at_most = count * np.minimum(FEW * self.drawn[rows], 1 / 4)
        return np.where(count > SINGLE, TOGETHER << np.log2(np.maximum(at_most / TOGETHER, 1)).astype(np.int64), 1)

    def shuffled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tables of all customers of the cells, cell by cell and in random order, and where each cell's begin."""
        sizes = self.own(rows).T
        cell, table = np.nonzero(sizes)
        each, start = sizes[cell, table], np.cumsum(self.count[rows]) - self.count[rows]
        if len(self.seats) > 1 << 16:
            order = np.argsort(np.repeat(cell, each) + self.rng.random(int(each.sum())))
            return np.repeat(table, each)[order], start
        # cell, a random number and table in one number, 65,536 cells at a time
        key = np.repeat((cell.astype(np.uint64) << np.uint64(48)) | table.astype(np.uint64), each)
        key |= self.rng.integers(0, 1 << 32, len(key), np.uint32).astype(np.uint64) << np.uint64(16)
        for part in np.split(key, start[1 << 16 :: 1 << 16]):
            part.sort()
        return (key & np.uint64(0xFFFF)).astype(np.int64), start

    def resit(self, rows: np.ndarray, weight, opened) -> None:
        """Every customer of the cells gets up once and sits down again.

        ``weight(cells)`` are the weights of a new table and how much more a further one has; ``opened(cells, by)`` is told
        of cells that have a table more or less (one as often as it has)."""
        tables, start = self.shuffled(rows)
        size, count = self.lots(rows), self.count[rows]
        for m in np.unique(size).tolist():
            at, done = np.flatnonzero(size == m), 0
            while len(at):
                cells, place = rows[at], start[at] + done
                if m == 1:
                    opened(cells[self.change(cells, tables[place], -1) == 0], -1)
                    opened(cells[self.sit(cells, weight(cells)[0])], 1)
                else:
                    need = np.minimum(count[at] - done, m)
                    self.together(cells, tables[np.minimum(place[:, None] + np.arange(m), len(tables) - 1)], need, weight, opened)
                done += m
                at = at[count[at] > done]

    def together(self, rows: np.ndarray, tables: np.ndarray, need: np.ndarray, weight, opened) -> None:
        """The first ``need`` customers of each row of ``tables`` get up and sit down again, by the law of all their seats given the others'.

        With weight A = customers - discount * tables at the tables that are left, g of m customers come to new ones with a chance in
        proportion to C(m, g) A (A + 1) ... (A + m - g - 1) V(g); V(g) sums the weights of all ways to seat g at s new tables
        over s.  The other m - g are an urn's draws from the tables that are left."""
        n, m = tables.shape
        k, one = np.arange(m), np.int32(1)
        at = tables * len(self.count) + rows[:, None]
        at = at.reshape(-1) if need.min() == m else at[k < need[:, None]]
        flat = self.seats.reshape(-1)
        np.subtract.at(flat, at, one)
        opened(np.unique(at[flat[at] == 0]) % len(self.count), -1)
        self.count[rows] -= need
        own = np.ascontiguousarray(self.own(rows).T)
        upto = np.cumsum(np.where(own > 0, own - self.discount, 0.0))
        end = upto[len(own[0]) - 1 :: len(own[0]), None]
        a = np.diff(end, axis=0, prepend=0)
        # g, the customers of new tables
        ways = partitions(self.discount)
        w, more = (np.broadcast_to(x, n)[:, None] for x in weight(rows))
        j = np.arange(TOGETHER)
        opens = np.cumprod(w + more * j, axis=1)  # weight of 1, 2, ... new tables
        each = np.maximum(need[:, None] - j, 0) / np.maximum(a + need[:, None] - 1 - j, 1e-9)
        v = np.concatenate((np.ones((n, 1)), opens @ ways[1:, 1:].T * np.cumprod(each, axis=1)), axis=1)
        g = np.minimum(self.pick(v), need)
        # the others: each draws from the tables that are left, or goes where one of those before it went
        draw = self.rng.random((n, m))
        draw *= a + k
        later = np.flatnonzero(draw >= a)
        to = np.arange(n * m)
        to[later] += np.minimum((draw.reshape(-1)[later] - a[later // m, 0]).astype(np.int64), later % m - 1) - later % m
        draw += end - a
        np.minimum(draw, np.nextafter(end, 0), out=draw)
        seat = np.searchsorted(upto, draw.reshape(-1), side="right")
        while len(later):
            to[later] = to[to[later]]
            later = later[to[to[later]] != to[later]]
        seat = seat[to].reshape(n, m) % len(own[0]) * len(self.count) + rows[:, None]
        np.add.at(flat, seat[k < (need - g)[:, None]], one)
        self.count[rows] += need
        # the new tables: their number, then the size of that of the first customer who has none yet
        at = np.flatnonzero(g)
        g, cells = g[at], rows[at]
        s = self.pick(opens[at] * ways[g, 1:]) + 1
        sizes = np.arange(1, TOGETHER + 1)
        while len(cells):
            rest = g[:, None] - sizes
            b = self.pick(np.where(rest >= 0, sizes * ways[sizes, 1] * ways[np.maximum(rest, 0), (s - 1)[:, None]], 0.0)) + 1
            free = self.own(cells) == 0
            if not free.any(axis=0).all():
                self.add_columns()
                continue
            self.seats[free.argmax(axis=0), cells] = b
            opened(cells, 1)
            g, s = g - b, s - 1
            g, cells, s = g[s > 0], cells[s > 0], s[s > 0]

    def pick(self, weights: np.ndarray) -> np.ndarray:
        """A column of each row, with chances in proportion to the weights."""
        upto = np.cumsum(weights, axis=1)
        return np.minimum((upto <= self.rng.random((len(weights), 1)) * upto[:, -1:]).sum(axis=1), weights.shape[1] - 1)


@functools.cache
def partitions(discount: float) -> np.ndarray:
    """[g, s]: the weights of all ways to seat g customers at s tables, those of a table of b being
    (1 - discount) (2 - discount) ... (b - 1 - discount), over g!."""
    out = np.zeros((TOGETHER + 1, TOGETHER + 1))
    out[0, 0] = 1
    s = np.arange(TOGETHER + 1)
    for g in range(TOGETHER):
        out[g + 1] = np.maximum(g - discount * s, 0) * out[g] / (g + 1)
        out[g + 1, 1:] += out[g, :-1] / (g + 1)
    return out


def running(x: np.ndarray, kind: type) -> np.ndarray:
    """Running sums down the columns; of many short columns row by row, as ``cumsum`` takes them one by one."""
    if x.shape[1] < 8 * len(x):
        return np.cumsum(x, axis=0, dtype=kind)
    out = np.empty(x.shape, kind)
    out[0] = x[0]
    for j in range(1, len(x)):
        np.add(out[j - 1], x[j], out=out[j])
    return out


class Bucket:
    """The seating of one bucket's words, given the totals of all restaurants."""

    def __init__(self, data: dict, totals: dict, seed: int):
        self.rng = np.random.default_rng(seed)
        self.word = np.cumsum(data["word"], dtype=np.int64)
        self.ctx, self.count, self.words = data["ctx"].astype(np.int64), data["count"].astype(np.int64), len(data["keys"])
        self.customers, self.open = totals["customers"], totals["tables"].astype(float).copy()
        self.d, self.d0, self.unknown = totals["d"], totals["d0"], 1.0 / (totals["words"] + 1)
        self.root_customers, self.root_open = totals["root_customers"], totals["root_tables"]
        # cells of one customer stay at one table; the others are grouped by size
        self.alone = np.bincount(self.word[self.count == 1], minlength=self.words)
        types = np.bincount(self.word[self.count > 0], minlength=self.words)
        root = np.maximum(types - self.d0, 0) / max(self.root_customers, 1)
        lot = np.flatnonzero(self.count > 1)
        self.tables = (self.count > 0).astype(np.int64)
        self.groups = []
        for low, high in ((2, 2), (3, 3), (4, 4), (5, 8), (9, 16), (17, 32), (33, 128), (129, 1024), (1025, 1 << 62)):
            rows = lot[(self.count[lot] >= low) & (self.count[lot] <= high)]
            for at in range(0, len(rows), 25_000):
                part = rows[at : at + 25_000]
                weight = (STRENGTH + self.d * self.open[self.ctx[part]]) * root[self.word[part]]
                self.groups.append((part, Cells(self.count[part], weight, self.d, self.rng), self.ctx[part]))
        self._count_tables()
        served = self.alone + np.bincount(self.word[lot], weights=self.tables[lot], minlength=self.words).astype(np.int64)
        self.root = Cells(served, np.full(self.words, self._root_weight()), self.d0, self.rng)

    def _root_weight(self) -> float:
        return (STRENGTH + self.d0 * self.root_open) * self.unknown

    def _count_tables(self) -> None:
        for part, cells, _ in self.groups:
            self.tables[part] = cells.tables()

    def root_p(self) -> np.ndarray:
        c, t = self.root.count, self.root.tables()
        return (c - self.d0 * t + self._root_weight()) / (STRENGTH + self.root_customers)

    def sweep(self) -> None:
        p = self.root_p()
        for part, cells, ctx in self.groups:
            base = p[self.word[part]]
            cells.resit(np.arange(len(part)), lambda rows, ctx=ctx, base=base: ((STRENGTH + self.d * self.open[ctx[rows]]) * base[rows], self.d * base[rows]),
                        lambda rows, by, ctx=ctx: np.add.at(self.open, ctx[rows], by))
        self._count_tables()
        # the parent's customers are the tables now: let those that closed go and new ones sit down
        want = np.bincount(self.word, weights=self.tables, minlength=self.words).astype(np.int64)
        rows = np.flatnonzero(self.root.count > want)
        while len(rows):
            self.root_open -= int(self.root.leave(rows).sum())
            rows = rows[self.root.count[rows] > want[rows]]
        rows = np.flatnonzero(self.root.count < want)
        while len(rows):
            self.root_open += int(self.root.sit(rows, self._root_weight()).sum())
            rows = rows[self.root.count[rows] < want[rows]]
        self.root.resit(np.flatnonzero(self.root.count > 1), lambda rows: (self._root_weight(), self.d0 * self.unknown), self._root_opened)

    def _root_opened(self, rows: np.ndarray, by: int) -> None:
        self.root_open += by * len(rows)

    def predictive(self) -> np.ndarray:
        """Probability of every (word, context) pair under the present seating."""
        back = STRENGTH + self.d * self.open[self.ctx]
        total = STRENGTH + self.customers[self.ctx]
        return (np.maximum(self.count - self.d * self.tables, 0) + back * self.root_p()[self.word]) / total


def seat(data: dict, totals: dict, sweeps: int, seed: int) -> tuple[Bucket, np.ndarray]:
    """A bucket after so many sweeps, and the predictive probabilities averaged over those but the first."""
    b = Bucket(data, totals, seed)
    mean = np.zeros(len(b.word))
    for k in range(sweeps):
        b.sweep()
        if k:
            mean += b.predictive() / (sweeps - 1)
    return b, mean


def shares(bucket: int, data: dict, tables: np.ndarray, root: tuple[float, float], parts: int) -> pd.DataFrame:
    """A bucket's customers and tables by context, and the parent's, in ranges of the contexts' keys."""
    n = len(data["before"])
    keys = np.append(data["before"], ROOT)
    customers, opened = np.bincount(data["ctx"], data["count"], n), np.bincount(data["ctx"], tables, n)
    customers, opened = (np.append(x, y).astype(np.int64) for x, y in zip((customers, opened), root))
    edge = np.searchsorted(keys, np.array([(k << 64) // parts for k in range(1, parts)], np.uint64))
    edge = np.concatenate(([0], edge, [n + 1]))
    cut = [{"keys": keys[a:b], "customers": small(customers[a:b]), "tables": small(opened[a:b])} for a, b in zip(edge, edge[1:])]
    return pd.DataFrame({"part": np.arange(parts, dtype=np.int32), "bucket": np.int32(bucket), "data": [pack(x) for x in cut]})


def add_shares(pdf: pd.DataFrame) -> pd.DataFrame:
    """The sums over all buckets for every bucket's contexts of one range, in the bucket's order."""
    parts = [unpack(x) for x in pdf["data"]]
    keys = distinct(np.concatenate([x["keys"] for x in parts]))
    at = [np.searchsorted(keys, x["keys"]) for x in parts]
    sums = {}
    for name in ("customers", "tables"):
        sums[name] = np.zeros(len(keys), np.int64)
        for x, k in zip(parts, at):
            sums[name][k] += x[name]
    release()
    return pdf[["part", "bucket"]].assign(data=[pack({name: small(v[k]) for name, v in sums.items()}) for k in at])


def first_shares(state: DataFrame, parts: int) -> DataFrame:
    """Shares of a seating in which every cell has one table."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for bucket, data in zip(pdf["bucket"], pdf["data"]):
                data = unpack(data)
                one = data["count"] > 0
                words = np.unique(np.cumsum(data["word"], dtype=np.int64)[one])
                yield shares(int(bucket), data, one, (one.sum(), len(words)), parts)
                release()

    return state.mapInPandas(run, SHARES)


SHARES = "part int, bucket int, data binary"


def with_totals(state: DataFrame, sent: DataFrame, fixed: dict, f, schema: str) -> DataFrame:
    """``f(bucket, data, totals)`` of every bucket, once all ``sent`` shares are added up."""
    def run(own: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        got = [unpack(x) for x in sums.sort_values("part")["data"]]
        customers, tables = (np.concatenate([x[name].astype(np.int64) for x in got]) for name in ("customers", "tables"))
        totals = {**fixed, "customers": customers[:-1], "tables": tables[:-1], "root_customers": float(customers[-1]), "root_tables": float(tables[-1])}
        out = f(int(own["bucket"].iloc[0]), unpack(own["data"].iloc[0]), totals)
        release()
        return out

    summed = sent.groupBy("part").applyInPandas(add_shares, SHARES).repartition(fixed["buckets"], "bucket")
    return state.groupBy("bucket").cogroup(summed.groupBy("bucket")).applyInPandas(run, schema)


def sample_shares(state: DataFrame, sent: DataFrame, fixed: dict, sweeps: int) -> DataFrame:
    """Shares after all buckets have sampled."""
    def run(bucket: int, data: dict, totals: dict) -> pd.DataFrame:
        b, _ = seat(data, totals, sweeps, bucket)
        return shares(bucket, data, b.tables, (b.root.count.sum(), b.root.tables().sum()), fixed["parts"])

    return with_totals(state, sent, fixed, run, SHARES)


def add_up(df: DataFrame, n: int) -> np.ndarray:
    """Sum of the arrays in ``totals``, of ``n`` numbers each."""
    out = np.zeros(n)
    for r in df.select(F.posexplode("totals").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def partial_sums(state: DataFrame, sent: DataFrame, fixed: dict, sweeps: int) -> DataFrame:
    """(block, data): per bucket and block the texts' sums of log probabilities, base terms and known tokens."""
    def run(bucket: int, data: dict, totals: dict) -> pd.DataFrame:
        b, p = seat(data, totals, sweeps, bucket + (1 << 20))
        log_p = np.log10(p)
        c = np.bincount(b.word, weights=b.count, minlength=b.words)[b.word]
        base, known = np.log10(c + 0.5), c > 0
        rows = []
        for x in data["parts"]:
            at = np.repeat(np.cumsum(x["step"], dtype=np.int64), x["count"])
            there = np.zeros(x["docs"], bool)
            there[x["doc"]] = True
            docs, place = np.flatnonzero(there), (np.cumsum(there) - 1)[x["doc"]]
            one = {"doc": small(docs), "log": np.bincount(place, log_p[at]).astype(np.float32),
                   "base": np.bincount(place, base[at]), "known": small(np.bincount(place, known[at]).astype(np.int64))}
            rows.append((x["block"], pack(one)))
        return pd.DataFrame(rows, columns=["block", "data"])

    return with_totals(state, sent, fixed, run, "block string, data binary")


def bucketed(df: DataFrame, n: int) -> DataFrame:
    """The rows, written in ``n`` buckets of the column ``bucket``; the table's name is given up, its files stay."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "cells")
    name = "tidemark_" + path.rsplit("/", 1)[1].replace("-", "_")
    # the data are compressed already; a codec would hold buffers of the size of a bucket outside the heap
    df.write.bucketBy(n, "bucket").option("compression", "none").option("path", path).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def score(docs: DataFrame, held_out) -> DataFrame:
    """Scores of all rows by a model of those for which the condition ``held_out`` is false."""
    kind = dict(docs.dtypes)["doc_id"]
    slim = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    size = docs.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    buckets = max(4, -(-size // (BUCKET * 6)))
    merged = bucketed(to_blocks(slim, buckets).groupBy("bucket")
                      .applyInPandas(merge_rows, "bucket int, block string, data binary, totals array<double>"), buckets)
    words, n1, n2, m1, m2, n_train = add_up(merged.filter("bucket >= 0"), 6)
    state, n_train = merged.filter("bucket >= 0").select("bucket", "data"), int(n_train)
    fixed = {"words": int(words), "d": discount(n1, n2), "d0": discount(m1, m2), "buckets": buckets, "parts": max(4, buckets // 4)}
    sent = first_shares(state, fixed["parts"])
    for sweeps in ROUNDS[:-1]:
        sent = sample_shares(state, sent, fixed, sweeps)
    sums = partial_sums(state, sent, fixed, ROUNDS[-1])
    scale = np.log10(n_train + 0.5 * (words + 1))

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(x) for x in pdf["data"]]
        head = next(x for x in parts if "doc_id" in x)
        n = head["n"]
        log, base, known = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n), np.int64)
        for x in parts:
            if "doc_id" not in x:
                log[x["doc"]] += x["log"]
                base[x["doc"]] += x["base"]
                known[x["doc"]] += x["known"]
        return pd.DataFrame({"doc_id": head["doc_id"], "held_out": head["held"], "n_tokens": n, "n_known": known, "train_tokens": n_train,
                             "base_score": base - n * scale, "score": log, "perplexity": 10 ** np.minimum(-log / n, 300)})

    rows = merged.filter("bucket < 0").select("block", "data").union(sums)
    return rows.groupBy("block").applyInPandas(finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                                       "base_score double, score double, perplexity double")


def discount(ones: float, twos: float) -> float:
    """Estimate from the numbers of things seen once and twice."""
    return float(min(max(ones / max(ones + 2 * twos, 1.0), 0.1), 0.95))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = row_cols(read(spark, sf_dir, "documents"), "doc_id", "text")
    return score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)
