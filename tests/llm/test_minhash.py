import random

import numpy as np
import pytest

from tidemark.llm import components, minhash as op


def test_sql(same_as_sql):
    same_as_sql("op4_tensored_minhash")


def brute(pairs, size, percent=80):
    sets = {}
    for i, t in pairs:
        w = [x.lower() for x in (t or "").split()]
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def clusters(seed, groups=6, each=14, words=60):
    """Chains and stars of near copies around the threshold, some exact copies."""
    rng, out = random.Random(seed), []
    for _ in range(groups):
        base = [f"v{rng.randrange(10**6)}" for _ in range(words)]
        last = base
        for k in range(each):
            new = list(last if k % 2 else base)
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                new[rng.randrange(words)] = f"v{rng.randrange(10**6)}"
            out.append(" ".join(new))
            last = new
    rng.shuffle(out)
    return list(enumerate(out, 1))


@pytest.mark.parametrize("seed,small_key", [(1, 24), (2, 2)])
def test_components_equal_brute_force(docs_of, monkeypatch, seed, small_key):
    monkeypatch.setattr(op, "SMALL_KEY", small_key)  # 2: keys go on node by node
    monkeypatch.setattr(op, "SALT_ROWS", 3)
    pairs = clusters(seed, 4 if small_key == 2 else 6, 10)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op.near_duplicates(docs_of(pairs), size=2).collect()}
    assert got == brute(pairs, 2)


def test_recall_at_the_threshold():
    """Pairs at a similarity of exactly 0.8 share a table key."""
    rng, missed = np.random.default_rng(5), 0
    for _ in range(400):
        x = rng.integers(0, 2**63, 225).astype(np.uint64)
        a, b = op.half_keys(x[:200]), op.half_keys(x[25:])  # 175 of 225 common: 0.78
        same = a == b
        missed += not (same[: op.SIDE].any() and same[op.SIDE :].any())
    assert missed <= 1


def test_odd_rows(odd_docs, no_docs):
    rows = op.near_duplicates(odd_docs, size=2).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[1] == by[1] and by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[4] == [(1, 4, True)] and by[7] == [(1, 4, False)]  # one word, equal but for case
    assert by[5] == [(16, 5, True)] * 2 and by[6] == [(16, 5, False)] and by[None] == [(17, 5, False)]
    assert by[8][0][1:] == (8, True) and by[9][0][1:] == (8, False)
    assert op.near_duplicates(no_docs).count() == 0


def test_null_ids_only(docs_of):
    rows = op.near_duplicates(docs_of([(None, "a b c"), (None, "a b c")]), size=2).collect()
    assert [(r["component_id"], r["kept"]) for r in rows] == [(None, True)] * 2


def test_stage_keeps_one_of_each_group(spark, docs_of):
    pairs = clusters(3, 3, 8) + [(900, None), (901, "")]
    docs = docs_of(pairs)
    kept = op.stage_near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    want = {i for i, (n, c) in brute(pairs, 5).items() if i == c}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_components_of_random_graphs(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)]
    up = {}

    def find(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    want = {i: find(i) for i in up if any(find(j) == find(i) and j != i for j in up)}
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == want
    assert components.components(spark.createDataFrame([], "x long, y long")).count() == 0
