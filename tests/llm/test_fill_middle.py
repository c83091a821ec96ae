import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import fill_middle as fm


def plain(doc_id, text):
    """The rule itself, unit by unit."""
    text = text or ""
    us = fm.UNIT.findall(text)
    d = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(us) + 1), h[1] % (len(us) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(us), "plain", None, None, text
    p, m, s = "".join(us[:a]), "".join(us[a:b]), "".join(us[b:])
    if h[3] % 100 < 20:
        return len(us), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(us), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def made(rows, cache=None):
    draws = []
    for i, _ in rows:
        d = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        draws.append(tuple(int(d[8 * k : 8 * k + 8], 16) for k in range(4)))
    return fm.transform_batch([t or "" for _, t in rows], draws, cache or fm.Summaries())


def random_text(r, size):
    return "".join(r.choice(["ab", "Zq", " ", "\n", "é", "💡", "9", "<", "<P", "S>", "word" * 40, "aaaaaaaa"]) for _ in range(size))


@pytest.mark.parametrize("seed", range(6))
def test_cuts_equal_the_rule(seed):
    r = random.Random(seed)
    rows = [(r.randrange(10**9), random_text(r, r.choice([0, 1, 3, 40, 900]))) for _ in range(60)]
    got = made(rows)
    assert got == [plain(*x) for x in rows]
    for (_, t), g in zip(rows, got):
        assert fm.restore(g[4], g[1]) == t


def test_texts_without_a_cut_point_and_runs():
    rows = [(i, t) for i, t in enumerate(["a" * 70_000, "." * 70_000, "ab" * 50_000, "x", "é" * 5000 + "z" * 9000, " " + "q" * 4096])]
    assert made(rows) == [plain(*x) for x in rows]


def test_shared_passages_share_chunks():
    """A passage is cut alike wherever it stands, so its chunks are read once."""
    r = random.Random(5)
    passage = " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(3000))
    cache = fm.Summaries()
    made([(1, passage)], cache)
    once = cache.read
    rows = [(i, "other words " * i + passage) for i in range(2, 12)]
    assert made(rows, cache) == [plain(*x) for x in rows]
    assert cache.read - once < 0.1 * once * len(rows)
    starts = fm.chunk_starts(fm.code_points(passage), np.array([len(passage)]))
    assert len(passage) / 1000 < len(starts) < len(passage) / 40


def test_cache_is_bounded():
    cache = fm.Summaries(limit=3000)
    r = random.Random(6)
    rows = [(i, random_text(r, 400)) for i in range(30)]
    assert made(rows, cache) == [plain(*x) for x in rows]
    assert sum(map(len, cache.known)) <= 3000


def test_rows(spark, odd_docs, no_docs):
    want = sorted(((r["doc_id"], *plain(r["doc_id"], r["text"])) for r in odd_docs.collect()), key=repr)
    assert sorted(map(tuple, fm.transformed(odd_docs).collect()), key=repr) == want
    assert fm.transformed(no_docs, digests=True).collect() == []
    for r in fm.transformed(odd_docs, digests=True).collect():
        w = next(x for x in want if x[0] == r["doc_id"])
        assert r["output_sha256"] == hashlib.sha256(w[5].encode()).hexdigest()


def test_markers_stay_plain(spark, docs_of):
    out = fm.transformed(docs_of([(i, f"some text with {m} inside") for i, m in enumerate(["<P>", "<S>", "<M>"])])).collect()
    assert {r["form"] for r in out} == {"plain"} and all(r["prefix_chars"] is None for r in out)


def test_equals_sql(same_as_sql):
    same_as_sql("op11_fill_in_middle")
