import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import pitman_yor as op

def held():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1


def frame(df):
    return {r["doc_id"]: r for r in df.collect()}


def brute(rows):
    """The fields that need no model."""
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    words = {i: (t or "").encode().lower().split() + [b"\n"] for i, t in rows}
    c = {}
    for i, w in words.items():
        if not out[i]:
            for x in w:
                c[x] = c.get(x, 0) + 1
    n, v = sum(c.values()), len(c)
    base = {i: sum(math.log10((c.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w) for i, w in words.items()}
    return {i: (out[i], len(w), sum(x in c for x in w), n, base[i]) for i, w in words.items()}


def test_counts_and_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = frame(op.score(docs, held()))
    assert len(got) == len(want)
    for i, (out, n, known, total, base) in want.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out, n, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_beats_the_base_on_held_out_texts_and_repeats(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    a, b = frame(op.score(docs, held())), frame(op.score(docs, held()))
    rows = [r for r in a.values() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.95 * sum(r["base_score"] for r in rows)
    assert all(math.isclose(a[i]["score"], b[i]["score"], rel_tol=1e-6) for i in a)


def one_bucket(texts, held=None):
    held = np.zeros(len(texts), bool) if held is None else held
    import pandas as pd

    rows = [r for r in op.block_rows("b", texts, list(range(len(texts))), held, 1) if r[0] == 0]
    m = op.merge(pd.DataFrame(rows, columns=["bucket", "block", "data"]))
    t = m["totals"].iloc[0]
    w = op.CONTEXTS + 1
    totals = {"customers": t[:w], "tables": t[w : 2 * w], "words": int(t[2 * w]), "root_customers": float(t[w : 2 * w].sum()),
              "root_tables": float(t[2 * w]), "d": 0.6, "d0": 0.5}
    return op.unpack(m["data"].iloc[0]), totals


def test_seating_is_consistent_and_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["a", "b", "c", "dd", "ee", "the", "of"], 40, p=[0.4, 0.2, 0.1, 0.1, 0.1, 0.05, 0.05])) for _ in range(60)]
    data, totals = one_bucket(texts)
    b, _ = op.seat(data, totals, 5, 1)
    for part, cells, _ in b.groups:
        assert (cells.sizes.sum(axis=1) == b.count[part]).all() and (cells.sizes >= 0).all() and (cells.count == b.count[part]).all()
        assert (b.tables[part] >= 1).all() and (b.tables[part] <= b.count[part]).all()
    # with one bucket the tables of the contexts are the totals, and the parent's customers
    assert np.allclose(np.bincount(b.word, weights=b.tables, minlength=b.words), b.root.count)
    # every context: known words (seen there or not) and the unknown word make one
    open_now = np.bincount(b.ctx, weights=b.tables, minlength=op.CONTEXTS + 1)
    b.open, b.root_customers, b.root_open = open_now, b.root.count.sum(), b.root.tables().sum()
    root, p = b.root_p(), b.predictive()
    unknown = b._root_weight() / (op.STRENGTH + b.root_customers)
    assert math.isclose(root.sum() + unknown, 1, rel_tol=1e-9)
    for c in np.unique(b.ctx):
        at = b.ctx == c
        back = (op.STRENGTH + b.d * open_now[c]) / (op.STRENGTH + totals["customers"][c])
        rest = back * (1 - root[b.word[at]].sum())
        assert math.isclose(p[at].sum() + rest, 1, rel_tol=1e-9)


def test_gibbs_reaches_the_exact_law_of_tables():
    """Three customers of one dish: the chance of 1, 2, 3 tables is known in closed form."""
    d, weight = 0.5, 0.7  # weight of a new table, held fixed
    cells = op.Cells(np.full(40_000, 3), np.full(40_000, weight), d, np.random.default_rng(3))
    rows = np.arange(40_000)
    for _ in range(40):
        cells.leave(rows)
        cells.sit(rows, np.full(40_000, weight))
    got = np.bincount(cells.tables(), minlength=4)[1:] / 40_000
    # partitions of three: one table (1-d)(2-d), three ways of two (1-d), one way of three
    law = np.array([(1 - d) * (2 - d), 3 * (1 - d) * weight, weight**2])
    assert np.allclose(got, law / law.sum(), atol=0.015)


def test_odd_rows(odd_docs, no_docs):
    rows = op.score(odd_docs, held()).collect()
    assert len(rows) == 11
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (1, 2, 3))
    assert all(not r["held_out"] for r in rows if r["doc_id"] is None)
    assert op.score(no_docs, held()).count() == 0


def test_without_training_rows(docs_of):
    rows = op.score(docs_of([(1, "a b"), (2, "c")]), F.lit(True)).collect()
    assert [(r["train_tokens"], r["n_known"], r["score"]) for r in rows] == [(0, 0, 0.0)] * 2


def test_blocks_do_not_change_counts(docs_of, monkeypatch):
    rows = [(i, " ".join(f"w{(i * j) % 17}" for j in range(1, 50))) for i in range(60)]
    data, _ = one_bucket([t for _, t in rows])
    import pandas as pd

    parts = [r for k in range(0, 60, 7) for r in op.block_rows(str(k), [t for _, t in rows[k : k + 7]], [0], np.zeros(len(rows[k : k + 7]), bool), 1) if r[0] == 0]
    split = op.unpack(op.merge(pd.DataFrame(parts, columns=["bucket", "block", "data"]))["data"].iloc[0])
    assert all((data[k] == split[k]).all() for k in ("keys", "word", "ctx", "count"))


def test_contexts_are_whole_words():
    """``xing`` and ``ying`` end alike, and are still two restaurants; all contexts of many words are kept apart."""
    data, _ = one_bucket(["xing a ying b"] * 3)
    word, ctx = np.cumsum(data["word"]), data["ctx"]
    followers = {}
    for w, c in zip(word, ctx):
        followers.setdefault(int(c), set()).add(int(w))
    assert len(data["before"]) == 5 and all(len(x) == 1 for x in followers.values())  # four words and the start of a text
    many = " ".join(f"w{i}" for i in range(3 * op.CONTEXTS))
    assert len(one_bucket([many])[0]["before"]) == 3 * op.CONTEXTS + 1


def test_the_word_before_tells_words_apart(docs_of):
    """After ``king`` comes a, after ``ring`` b: a text of seen pairs is likelier than the same words in other pairs."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(x for k in rng.integers(0, 2, 30) for x in (("king", "a") if k else ("ring", "b")))) for i in range(80)]
    rows += [(1000, "king a ring b " * 5), (1001, "king b ring a " * 5)]
    got = frame(op.score(docs_of(rows), F.col("doc_id") >= 1000))
    assert got[1000]["score"] > got[1001]["score"] + 5
    assert math.isclose(got[1000]["base_score"], got[1001]["base_score"], rel_tol=1e-9)


def test_totals_of_contexts_are_added_over_buckets():
    rows = [r for r in op.block_rows("b", ["a b a c b a", "c a b b"], [1, 2], np.zeros(2, bool), 3) if r[0] >= 0]
    import pandas as pd

    merged = [op.unpack(op.merge(pd.DataFrame([r], columns=["bucket", "block", "data"]))["data"].iloc[0]) for r in rows]
    sent = pd.concat([op.shares(i, x, x["count"] > 0, (1, 2), 4) for i, x in enumerate(merged)])
    back = pd.concat([op.add_shares(x) for _, x in sent.groupby("part")])
    totals = {}
    for i, x in enumerate(merged):
        got = [op.unpack(d) for d in back[back["bucket"] == i].sort_values("part")["data"]]
        customers, tables = (np.concatenate([g[n] for g in got]) for n in ("customers", "tables"))
        assert len(customers) == len(x["before"]) + 1 and (customers[-1], tables[-1]) == (len(merged), 2 * len(merged))
        totals |= {int(k): (int(c), int(t)) for k, c, t in zip(x["before"], customers, tables)}
    key = lambda w: op.xxhash.xxh3_64_intdigest(w)
    # what follows: a: b c end b, b: a a b end, c: b a, start: a c
    assert totals == {key(b"a"): (4, 3), key(b"b"): (4, 3), key(b"c"): (2, 2), key(op.END): (2, 2)}


def test_a_frequent_word_does_not_scan_all_words(monkeypatch):
    """Customers of the parent move in the words that have some to move: a sweep looks over all words a few times only."""
    texts = [" ".join(f"x{i} the" for i in range(k, k + 100)) for k in range(0, 2000, 100)]
    data, totals = one_bucket(texts)
    b = op.Bucket(data, totals, 1)
    b.root.count[:], b.root.sizes[:], b.root.sizes[:, 0] = 1, 0, 1  # far from the tables that the cells have
    full, scan = [], np.flatnonzero
    monkeypatch.setattr(op.np, "flatnonzero", lambda x: (full.append(1) if len(x) == b.words else None, scan(x))[1])
    b.sweep()
    assert np.allclose(np.bincount(b.word, weights=b.tables, minlength=b.words), b.root.count) and b.root.count.max() > 1000
    assert len(full) <= 10


def test_pairs_sorted_in_one_number_or_by_argsort(monkeypatch):
    """Texts, words and contexts too many for one number are sorted in the other way, with the same rows."""
    texts = [" ".join(f"w{(i * j) % 17}" for j in range(1, 50)) for i in range(60)]
    held = np.zeros(60, bool)
    want = [op.unpack(r[2]) for r in op.block_rows("b", texts, list(range(60)), held, 3)]
    monkeypatch.setattr(op, "NUMBER_BITS", 8)
    for a, b in zip(want, [op.unpack(r[2]) for r in op.block_rows("b", texts, list(range(60)), held, 3)], strict=True):
        assert a.keys() == b.keys() and all(np.array_equal(a[k], b[k]) for k in a)


def test_running_sums_and_distinct_values():
    rng = np.random.default_rng(4)
    for shape in ((5, 1000), (50, 20), (1, 7), (3, 0)):
        x = rng.random(shape)
        assert (op.running(x, np.float64) == np.cumsum(x, axis=0)).all()
    for n in (0, 1, 500):
        x = rng.integers(0, 100, n).astype(np.uint64)
        assert np.array_equal(op.distinct(x), np.unique(x))


def test_what_blocks_send_is_small_and_whole():
    """Keys and numbers are sent as differences: back they are the same, in fewer bytes than the plain arrays compressed."""
    import pickle

    import zstandard

    rng = np.random.default_rng(5)
    x = {"keys": np.unique(rng.integers(0, 2**64, 20_000, dtype=np.uint64)), "before": np.array([2**64 - 1, 0, 5], np.uint64),
         "ctx": rng.integers(0, 2**16, 1000).astype(np.uint16), "count": np.zeros(0, np.uint8)}
    back = op.unpack(op.pack(x))
    assert back.keys() == x.keys() and all(back[k].dtype == x[k].dtype and np.array_equal(back[k], x[k]) for k in x)
    assert np.array_equal(op.unpack(op.pack({"ctx": np.zeros(0, np.uint8)}))["ctx"], np.zeros(0, np.uint8))
    assert len(op.pack(x)) < 0.9 * len(zstandard.ZstdCompressor(level=1).compress(pickle.dumps(x, protocol=5)))


def law_of_tables(count, weight, more, d):
    """Chances of 1, 2, ... tables of one cell, by the recursion over its customers."""
    ways = np.zeros(count + 1)
    ways[0] = 1
    for n in range(count):
        ways = (np.maximum(n - d * np.arange(count + 1), 0) * ways + np.concatenate(([0], ways[:-1]))) / max(n, 1)
    law = np.log(np.maximum(ways[1:], 1e-300)) + np.cumsum(np.log(weight + more * np.arange(count)))
    law = np.exp(law - law.max())
    return law / law.sum()


def test_customers_that_get_up_together_follow_the_exact_law():
    """Cells with few and many tables, whose customers get up one by one or in lots: the tables have the law of all seatings."""
    for count, weight, more, d, lot, sweeps in ((5, 0.7, 0.1, 0.5, 1, 6), (100, 8.0, 0.02, 0.4, 32, 12), (70, 30.0, 0.02, 0.3, 32, 6), (1000, 0.3, 0.002, 0.7, 128, 12)):
        cells = op.Cells(np.full(2_500, count), np.full(2_500, weight), d, np.random.default_rng(3))
        rows, opened, before = np.arange(2_500), np.zeros(2_500, np.int64), cells.tables()
        for _ in range(sweeps):
            cells.resit(rows, lambda r: (weight + more * (cells.seats[:, r] > 0).sum(axis=0), np.full(len(r), more)), lambda at, by: np.add.at(opened, at, by))  # noqa: B023
        assert set(cells.lots(rows)) == {lot}
        assert (cells.sizes.sum(axis=1) == count).all() and (cells.sizes >= 0).all() and (cells.count == count).all()
        assert (cells.tables() - before == opened).all()
        law, t = law_of_tables(count, weight, more, d), np.arange(1, count + 1)
        assert np.abs(np.bincount(cells.tables(), minlength=count + 1)[1:] / 2_500 - law).max() < 0.04
        assert abs(cells.tables().mean() / (law * t).sum() - 1) < 0.04


def test_a_sweep_moves_every_customer_of_a_large_cell():
    """The 3,000 customers of one pair, and those of the parent, start at 3,000 tables of one; a sweep leaves no such seating."""
    data, totals = one_bucket(["x y " * 60] * 50)
    b = op.Bucket(data, totals, 1)
    large = [(part, cells) for part, cells, _ in b.groups if cells.count.max() >= 2_000]
    assert large
    for part, cells in large:
        for i in np.flatnonzero(cells.count >= 2_000):
            n = int(cells.count[i])
            cells.seats = np.pad(cells.seats, ((0, max(0, n + 8 - len(cells.seats))), (0, 0)))
            cells.seats[:, i] = 0
            cells.seats[:n, i] = 1
    b._count_tables()
    b.open[:] = 0
    np.add.at(b.open, b.ctx, b.tables)
    assert b.tables.max() >= 2_000
    b.sweep()
    assert b.tables.max() < 1_500 and b.root.count.max() < 3_000
    b.sweep()
    b.sweep()
    assert b.tables.max() < 1_000
    for part, cells, _ in b.groups:
        assert (cells.sizes.sum(axis=1) == b.count[part]).all()
    assert np.allclose(np.bincount(b.word, weights=b.tables, minlength=b.words), b.root.count)
