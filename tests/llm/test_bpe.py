import base64
import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import bpe as op
from tidemark.llm.common import read

tiktoken = pytest.importorskip("tiktoken")
vocabularies = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def reference():
    lines = map(bytes.split, open(op.default_ranks(), "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    return tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(reference, texts):
    enc = op.encoder(op.default_ranks())
    ids, offsets = enc.encode(texts)
    for t, x, at in zip(texts, ids, offsets):
        assert x.tolist() == reference.encode_ordinary(t), t[:60]
        assert enc.decode(x) == t.encode()
        assert at.tolist() == list(np.cumsum([0, *[len(reference.decode_single_token_bytes(i)) for i in x]]))[: len(x)]


def test_boundaries(reference):
    same(reference, ["", "a", " ", "  ", "'s", "''s", "x's", "x'stop", "'re're", "!'s", " 's", "\n's", "a  b", "a \n b", "a\n\nb ", "\0", "a\0b", "'ll", "'l",
                     "x'", "12ab 34", "\t\tx", "  \t x", "  a", "'S", "don't 'tis", " ''s", "é's", "x y", "　 　a", "١٢ a²", "🙂🙂 a", "á e"])


def test_random_texts(reference):
    rng = random.Random(1)
    for alphabet in ("ab 's\n\t'relvmdt1!é 　１ \0", " \n\r\t'a", "".join(map(chr, range(32, 400)))):
        same(reference, ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)])


def test_every_code_point_class(reference):
    points = [chr(c) for c in range(0, 0x3100) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0xF900, 0x20000, 7)]
    same(reference, ["a" + c + "a 1" + c + "1" + c for c in points])


def test_very_long_slices(reference):
    rng = random.Random(2)
    same(reference, ["a" * 5000, "!" * 1000 + "é" * 700, "".join(rng.choice("abcdefgh") for _ in range(4000)), "ab" * 3000 + " " * 999])


def test_scan_equals_the_automaton_step_by_step():
    rng = np.random.default_rng(0)
    step, cut = op.automaton()
    for n in (1, 2, 15, 16, 17, 1000, 20_011):
        cls = rng.integers(0, op.CUT + 1, n).astype(np.uint8)
        state, want = op.START, []
        for c in cls:
            want.append(bool(cut[c, state]))
            state = step[c, state]
        assert op.boundaries(cls).tolist() == want


def test_query_equals_the_library(spark, reference):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op.query(spark, sf).collect()}
    for d in read(spark, sf, "documents").collect():
        ids = reference.encode_ordinary(d["text"] or "")
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_odd_rows(odd_docs, no_docs):
    rows = op.encode(odd_docs).collect()
    assert len(rows) == 11 and [r["ids"] for r in rows if r["doc_id"] in (1, 2)] == [[], []]
    assert op.encode(no_docs).count() == 0 and op.digests(no_docs).count() == 0


def test_cache_bound_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(op, "CACHE", 3)
    same(reference, ["one two three four"])
    same(reference, ["five six seven eight one two"])
