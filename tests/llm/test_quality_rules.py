import numpy as np

from tidemark.llm import quality_rules as op
from tidemark.llm.common import doc_words


def test_sql(same_as_sql):
    same_as_sql("op7_quality_rules")


def brute(text, window=5):
    w = text.split()
    seen = {}
    for i in range(len(w) - window + 1):
        seen.setdefault(tuple(w[i : i + window]), []).append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(window)})


def test_repeated_words_against_brute_force():
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(list("abc"), rng.integers(0, 60))) for _ in range(300)] + ["", "a b c d e " * 9]
    ids, lens, _ = doc_words(texts)
    assert op.repeated_words(ids, lens).tolist() == [brute(t) for t in texts]


def rows(spark, hosts):
    data = [(k, text, host) for k, (host, text) in enumerate(hosts)]
    return spark.createDataFrame(data, "doc_id long, text string, source string")


GOOD = "these are twelve plain words of prose that no rule would ever refuse"
BAD = "buy now"


def test_bad_host_takes_its_documents_along(spark):
    docs = rows(spark, [("https://www.Spam.example/a", BAD)] * 95 + [("spam.example", GOOD)] * 5 + [("fine.example", GOOD)] * 95
                + [("fine.example", BAD)] * 5 + [("small.example", BAD)] + [(f"h{i}.example", GOOD) for i in range(60)] + [("small.example", GOOD)])
    got = op.quality_rules(docs).collect()
    failed = {r["host"] for r in got if r["host_failed"]}
    assert failed == {"spam.example"}
    assert not any(r["kept"] for r in got if r["host"] == "spam.example")
    assert all(r["kept"] for r in got if r["host"] == "fine.example" and not r["base_failed"])


def test_prior():
    assert op.beta_prior(0, 0, 0, 0.0) == (0.0, 10000.0)
    p, strength = op.beta_prior(100, 10, 20, 4.0)  # all hosts alike: the prior is strong
    assert p == 0.2 and strength == 10000.0
    assert op.beta_prior(200, 2, 100, 100.0)[1] == 1.0  # hosts all good or all bad: it is weak


def test_odd_rows(spark, odd_docs, no_docs):
    got = op.quality_rules(odd_docs).collect()
    assert len(got) == 11 and not any(r["kept"] for r in got if r["doc_id"] in (1, 2, 3, 4, 7))
    assert op.quality_rules(no_docs).count() == 0
    assert op.quality_rules(rows(spark, [(None, GOOD), ("", GOOD)])).filter("kept").count() == 2


def test_stage_drops_only_refused(spark, odd_docs):
    out = op.stage_quality(spark, odd_docs, "")
    assert out.columns == odd_docs.columns
    want = sorted(str(r["doc_id"]) for r in op.quality_rules(odd_docs).collect() if r["kept"])
    assert sorted(str(r["doc_id"]) for r in out.collect()) == want
