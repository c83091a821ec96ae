import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import nbsvm as op
from tidemark.llm.common import read

SF = "/root/testdata/sf0.01"


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in op.query(spark, SF).collect()}
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for i, r in got.items())
    y = [(r["quality"], got[r["doc_id"]]["predicted"]) for r in read(spark, SF, "labels").collect() if held(r["doc_id"])]
    assert len(y) > 80 and np.mean([a == b for a, b in y]) > 0.95
    assert np.mean([b == 0 for a, b in y if a == 0]) > 0.8 and np.mean([b for a, b in y if a == 1]) > 0.97


def test_held_out_labels_are_not_read(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    flipped = labels.withColumn("quality", F.when(op.remainder(F.col("doc_id"), 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = op.fit(docs, labels), op.fit(docs, flipped)
    assert np.allclose(a["r"], b["r"]) and np.allclose(a["w"], b["w"])


def test_ratios_against_brute_force(spark):
    docs, labels = read(spark, "/root/testdata/sf0.001", "documents"), read(spark, "/root/testdata/sf0.001", "labels")
    y = {r["doc_id"]: r["quality"] for r in labels.collect() if not held(r["doc_id"])}
    n = np.ones((2, op.DIM))
    for r in docs.collect():
        if r["doc_id"] in y:
            n[y[r["doc_id"]]][op.features(r["text"])] += 1
    want = np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum())
    assert np.allclose(op.fit(docs, labels)["r"], want)


def test_features_are_distinct_and_alike_for_any_length():
    short = "Plain words here. " * 5
    long = "Plain words here. " * 900
    a, b = op.features(short), op.features(long)
    assert len(set(a.tolist())) == len(a) and set(a.tolist()) == set(b.tolist())


def test_dual_descent_separates():
    rng = np.random.default_rng(0)
    xs, ys = [], []
    for _ in range(300):
        y = rng.integers(0, 2) * 2 - 1
        xs.append(np.unique(rng.integers(0, 20, 6) + (20 if y > 0 else 0)))
        ys.append(y)
    w, bias = op.dual_descent(xs, np.array(ys), np.ones(40), penalty=1.0)
    assert all(np.sign(w[x].sum() / np.sqrt(len(x)) + bias) == y for x, y in zip(xs, ys))


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1), (5, 0), (8, 0), (9, 0), (6, 1), (None, 1), (77, 1), (4, None)], "doc_id long, quality long")
    got = op.scores(odd_docs, op.fit(odd_docs, labels)).collect()
    assert len(got) == 11 and all(0 <= r["score"] <= 1 for r in got)
    assert op.scores(no_docs, op.fit(no_docs, labels)).count() == 0
    assert op.fit(no_docs, labels.limit(0)) == {"share": 0.5}
    one = spark.createDataFrame([(i, 1) for i in range(1, 10)], "doc_id long, quality long")
    assert {r["score"] for r in op.scores(odd_docs, op.fit(odd_docs, one)).collect()} == {1.0}


def test_a_rare_class_is_sampled(spark, docs_of):
    """Five rows of one class among thousands, and a third of all rows under one id: both classes reach the support vectors."""
    clean = [(i, f"plain words about topic {i % 97} and nothing else {i}") for i in range(6000)]
    bad = [(10_000 + i, f"## $$ || << buy {i} now >> %% ## {i}") for i in range(40)]
    docs = docs_of(clean + bad + [(5, clean[5][1])] * 3000)
    labels = spark.createDataFrame([(i, 1) for i, _ in clean] + [(i, 0) for i, _ in bad], "doc_id long, quality long")
    train = docs.filter(op.remainder(F.col("doc_id"), 3) != 1).join(labels.withColumnRenamed("quality", "y"), "doc_id")
    got = op._sample(train, 400).collect()
    n_bad = sum(not held(i) for i, _ in bad)
    assert sum(r["y"] == 0 for r in got) == n_bad and 280 < len(got) < 520 and len({r["text"] for r in got}) == len(got)
    model = op.fit(docs, labels, sample=400)
    assert len(set(model["w"].tolist())) > 10
    y = {r["doc_id"]: r["score"] >= 0.5 for r in op.scores(docs, model).collect()}
    assert np.mean([not y[i] for i, _ in bad if held(i)]) > 0.9 and np.mean([y[i] for i, _ in clean if held(i)]) > 0.9


def test_shares_of_the_classes():
    assert op.shares((10, 10), 100) == (1.0, 1.0) and op.shares((5, 1000), 100) == (1.0, 0.095)
    assert op.shares((1000, 1000), 100) == (0.05, 0.05) and op.shares((0, 1000), 100) == (0.0, 0.1)
    assert op.shares((3, 3), 2) == (1 / 3, 1 / 3)


def test_weights_against_a_plain_solver():
    """The hinge objective of the descent is the least that projected gradient steps on the dual reach."""
    rng = np.random.default_rng(3)
    xs = [np.unique(rng.integers(0, 12, 5)) for _ in range(60)]
    y = rng.choice([-1, 1], 60, p=[0.3, 0.7])
    r = rng.normal(size=12)
    w, bias = op.dual_descent(xs, y, r, penalty=1.0, epochs=400)
    m = np.zeros((60, 13))
    for i, x in enumerate(xs):
        m[i, x] = r[x] / np.sqrt((r[x] ** 2).sum())
    m[:, 12] = 1
    top = 1.0 / (2 * np.where(y > 0, (y > 0).mean(), (y < 0).mean()))
    cost = lambda v: v @ v / 2 + (top * np.maximum(0, 1 - y * (m @ v))).sum()
    a, q = np.zeros(60), (m * y[:, None]) @ (m * y[:, None]).T
    for _ in range(20_000):
        a = np.clip(a - (q @ a - 1) / np.linalg.norm(q, 2), 0, top)
    best = cost((m * y[:, None]).T @ a)
    assert abs(cost(np.append(w, bias)) - best) < 1e-3 * best
