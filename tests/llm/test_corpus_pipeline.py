import hashlib

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_minhash import brute
from tidemark.llm import bpe, decontaminate, quality_rules, secrets
from tidemark.llm.common import read

SF = "/root/testdata/sf0.01"


def test_against_brute_force(spark):
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    import public_tokenizers

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.default_ranks(), "rb"))})
    docs = {r["doc_id"]: r for r in read(spark, SF, "documents").collect()}
    keep = {r["doc_id"] for r in quality_rules.quality_rules(read(spark, SF, "documents")).collect() if r["kept"]}
    groups = brute([(i, docs[i]["text"]) for i in sorted(keep)], 5)
    keep = {i for i in keep if groups[i][1] == i}
    dirty = {r["doc_id"] for r in decontaminate.query(spark, SF).collect() if r["contaminated"]}
    assert dirty & keep
    keep -= dirty
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == keep and len(keep) > 500
    redacted = 0
    for i, r in got.items():
        text = secrets.redact(docs[i]["text"])
        redacted += text != docs[i]["text"]
        assert r["ids"] == enc.encode_ordinary(text) and r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
        assert (r["lang"], r["source"]) == (docs[i]["lang"], docs[i]["source"])
    assert redacted


def test_stages_return_the_columns_of_documents(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(0, "a benchmark item of some seven words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd_docs, no_docs):
        for name, f in corpus_pipeline.STAGES[:-1]:
            out = f(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            out.count()
    assert bpe.stage_encode(spark, odd_docs, "").count() == 11


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline"} <= names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(entry.oracle_sql()) <= names


def test_rows_with_null_or_shared_ids(spark, docs_of, tmp_path):
    """Verdicts hold for rows: null ids do not save a row, and a row does not go for another one with its id."""
    item = "On market day the old farmer sold all of the apples to a neighbour who lived behind the mill"
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    text = {k: " ".join(f"{k}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)) for k in "abc"}

    def left(name, rows):
        return sorted(((r["doc_id"], r["text"]) for r in dict(corpus_pipeline.STAGES)[name](spark, docs_of(rows), str(tmp_path)).collect()), key=repr)

    clean = sorted([(5, text["a"]), (None, text["b"])], key=repr)
    assert left("quality_rules", [*clean, (5, "too short"), (None, "short")]) == clean
    assert left("decontaminate", [*clean, (5, item), (None, item)]) == clean
    # 5 is the smallest id of a's group and a further one of b's; c is only under null ids
    rows = [(5, text["a"]), (5, text["a"]), (7, text["a"]), (None, text["a"]), (3, text["b"]), (5, text["b"]), (None, text["c"]), (None, text["c"])]
    assert left("near_dedup", rows) == sorted([(5, text["a"]), (3, text["b"]), (None, text["c"])], key=repr)


def test_a_batch_is_worked_on_in_parts():
    """Objects of a few megabytes at a time, however large a batch is."""
    import tracemalloc

    import pyarrow as pa

    line = "the words of a text that is cut and merged " * 1000
    texts = pa.array([line + str(i) for i in range(100)] + [None, ""])
    rows = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(102)), "text": texts, "lang": texts, "source": texts})
    enc = bpe.encoder(bpe.default_ranks())
    bpe.class_table()
    peaks, parts, n = [], 0, 0
    tracemalloc.start()
    for f in (lambda: list(map(lambda b: (b.num_rows, pa.compute.sum(b.column("n_tokens")).as_py()), bpe.encode_parts(iter([rows]), enc))),
              lambda: secrets.redact_parts(texts)):
        tracemalloc.reset_peak()
        out = f()
        peaks.append(tracemalloc.get_traced_memory()[1])
        if isinstance(out, list):
            parts, n = len(out), sum(x[0] for x in out)
        else:
            assert out.equals(texts)
    tracemalloc.stop()
    assert n == 102 and parts > 10
    assert max(peaks) < 20 << 20
