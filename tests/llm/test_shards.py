import itertools
import math
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import shards as op


def test_exact_sizes_and_gapless_slots(spark):
    rows = op.query(spark, "/root/testdata/sf0.01").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        data = (docs[r["doc_id"]] or "").encode()
        assert r["size"] == len(data) + 1 and r["text_crc32"] == zlib.crc32(data) and r["law"] == "rows" and r["grown_shard"] is None
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))


def test_matrix_has_its_sums():
    counts, blocks = [0, 7, 100, 3, 41], [b[2] for b in op.block_sizes(151, 8, 4)]
    m = np.array(op.communication_matrix(counts, blocks, 5))
    assert m.sum(axis=1).tolist() == counts and m.sum(axis=0).tolist() == blocks and (m >= 0).all()


def test_matrix_follows_the_hypergeometric_law():
    """Two groups of two rows, two blocks of two: a group's rows go to one block with chance 1/3."""
    n = 6000
    together = sum(op.communication_matrix([2, 2], [2, 2], s)[0][0] != 1 for s in range(n))
    assert abs(together / n - 1 / 3) < 0.03


def test_large_numbers_keep_their_sums():
    m = np.array(op.communication_matrix([3 * 10**9, 10**9], [2 * 10**9, 2 * 10**9], 1))
    assert m.sum(axis=1).tolist() == [3 * 10**9, 10**9] and m.sum(axis=0).tolist() == [2 * 10**9, 2 * 10**9]
    assert abs(m[0, 0] - 1.5e9) < 1e6


def test_every_order_of_few_rows_comes_up(docs_of):
    docs = docs_of([(i, "t") for i in range(3)]).coalesce(1)
    seen = Counter()
    for seed in range(30):
        rows = op.uniform_shards(docs, shards=1, seed=seed, aim=2).collect()
        seen[tuple(r["doc_id"] for r in sorted(rows, key=lambda r: r["slot"]))] += 1
    assert len(seen) >= 5 and set(seen) <= set(itertools.permutations(range(3)))


def test_odd_rows(odd_docs, no_docs):
    rows = op.uniform_shards(odd_docs).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in rows) == sorted((r["doc_id"] or 0, len((r["text"] or "").encode()) + 1) for r in odd_docs.collect())
    assert len(rows) == 11 and len({(r["shard"], r["slot"]) for r in rows}) == 11
    assert [r["size"] for r in rows if r["doc_id"] in (1, 2)] == [1, 1]
    assert op.uniform_shards(no_docs).count() == 0


def test_no_python_in_the_plan(spark):
    plan = op.query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "SinglePartition" not in plan


def test_pieces_of_a_group_give_the_same_law_and_no_gap(docs_of):
    rows = op.uniform_shards(docs_of([(i, f"t{i}") for i in range(500)]), shards=3, aim=64, piece=5).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(500))
    for s in range(3):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots))) and len(slots) in (166, 167)


def test_equal_rows_are_spread_over_groups(docs_of):
    docs = docs_of([(7, "copy")] * 1500 + [(i, f"t{i}") for i in range(1500)]).coalesce(4)
    rows = op.uniform_shards(docs, aim=16).collect()
    sizes = Counter(r["shard"] for r in rows)
    copies = Counter(r["shard"] for r in rows if r["doc_id"] == 7 and r["size"] == 5)
    assert set(sizes.values()) == {375} and all(abs(n - 187.5) < 60 for n in copies.values()) and len(copies) == 8


def exact_chances(a, b, total):
    logs = [-sum(math.lgamma(x + 1) for x in (k, a - k, b - k, total - a - b + k)) for k in range(max(0, a + b - total), a + 1)]
    top = max(logs)
    p = np.exp(np.array(logs) - top)
    return p / p.sum()


@pytest.mark.parametrize("a,b,total", [(40, 70, 200), (900, 1500, 6000), (30, 9000, 10000), (60, 60, 100)])
def test_rejection_has_the_exact_law(a, b, total):
    """Chi-square of draws against the exact chances, and logarithms of chances against factorials."""
    p, lowest, n = exact_chances(a, b, total), max(0, a + b - total), 20_000
    rng = np.random.default_rng(11)
    seen = np.bincount([op._ratio_of_uniforms(rng, a, b, total) - lowest for _ in range(n)], minlength=len(p))
    often = p * n >= 8
    chi = ((seen - p * n)[often] ** 2 / (p * n)[often]).sum()
    assert seen.sum() == n and chi < often.sum() + 5 * (2 * often.sum()) ** 0.5
    mode = (a + 1) * (b + 1) // (total + 2)
    for k in np.flatnonzero(p > 1e-12) + lowest:
        assert abs(op.log_chance(int(k), mode, a, b, total) - math.log(p[k - lowest] / p[mode - lowest])) < 1e-7


def test_chances_keep_their_precision_at_large_numbers():
    """Against whole-number products: p(k + 1) / p(k) has a closed form."""
    a, b, total = 10**8, 3 * 10**11, 10**12
    mode = (a + 1) * (b + 1) // (total + 2)
    want, k = Fraction(1), mode
    for _ in range(40):
        want *= Fraction((a - k) * (b - k), (k + 1) * (total - a - b + k + 1))
        k += 1
    assert abs(op.log_chance(k, mode, a, b, total) - math.log(want)) < 1e-9


def test_large_draws_have_mean_and_spread():
    rng = np.random.default_rng(2)
    good, total, n = 3 * 10**9, 10**10, 4 * 10**9
    x = np.array([op._draw(rng, good, total - good, n) for _ in range(2000)], float)
    sd = (n * 0.3 * 0.7 * (total - n) / (total - 1)) ** 0.5
    assert abs(x.mean() - n * 0.3) < 5 * sd / 2000**0.5 and abs(x.std() / sd - 1) < 0.08
    few = np.array([op._draw(rng, 5, 2 * 10**9, 10**9) for _ in range(3000)])
    assert abs(few.mean() - 2.5) < 0.12 and few.min() >= 0 and few.max() <= 5
