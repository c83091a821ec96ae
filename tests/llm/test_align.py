import collections
import hashlib
import random

import pytest

from tidemark.llm import align

COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    """Token by token, link by link."""
    both = align.pair(*align.default_paths())
    byte = align.byte_alphabet()
    names = {i: s for s, i in both.a.get_vocab().items()}
    docs = []
    for _, text in rows:
        docs.append(([], [], [], ""))
        if not text:
            continue
        a = [(i, bytes(byte[c] for c in names[i])) for i in both.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in both.b.encode(text):
            p = both.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" and p[5] == ">" else p.replace("▁", " ").encode()))
        want = b" " + text.encode()
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            continue
        groups, links, x, y, i, j = [], [], [], [], 0, 0
        ea = eb = 0
        while i < len(a) or j < len(b):
            if ea <= eb:
                x.append(a[i][0])
                ea += len(a[i][1])
                i += 1
            else:
                y.append(b[j][0])
                eb += len(b[j][1])
                j += 1
            if ea == eb:
                links.append((x[-1], y[-1]))
                groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
                x, y = [], []
        docs[-1] = (a, b, links, hashlib.sha256(";".join(groups).encode()).hexdigest())
    n = collections.Counter(p for d in docs for p in d[2])
    most = collections.defaultdict(int)
    for (_, b), k in n.items():
        most[b] = max(most[b], k)
    return [(r[0], len(d[0]), len(d[1]), len(d[2]), len(d[2]), sum(n[p] == most[p[1]] for p in d[2]), sum(n[p] for p in d[2]), d[3])
            for r, d in zip(rows, docs)]


def check(got, rows):
    assert sorted(map(tuple, got.select(*COLS).collect()), key=repr) == sorted(brute(rows), key=repr)


TEXTS = ["Hello world, this is a test of alignment.", "a", " ", "\n\n  two  spaces\tand a tab", "naïve café 💡 日本語 text", "<|endoftext|> and <s> </s> <unk> <0x41>",
         "piece▁mark", " non-breaking Ａ wide", "the the the the cat", "Unbelievably long-winded internationalization", "x" * 3000, "\0nul\x7f"]


def test_against_brute_force(spark, docs_of):
    rows = list(enumerate(TEXTS))
    check(align.alignment(docs_of(rows)), rows)


def test_documents(spark):
    from tests.llm.conftest import SF
    from tidemark.llm.common import read

    rows = [(r["doc_id"], r["text"]) for r in read(spark, SF, "documents").collect()]
    got = align.query(spark, SF)
    check(got, rows)
    assert sum(r["n_links"] for r in got.collect()) > 1000


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    check(align.alignment(odd_docs), rows)
    assert align.alignment(no_docs).collect() == [] and sorted(align.alignment(no_docs).columns) == sorted(COLS)


def test_not_spelled_back_has_no_tokens(spark, docs_of):
    row = align.alignment(docs_of([(1, "piece▁mark")])).collect()[0]
    assert (row["n_a"], row["n_b"], row["n_links"], row["count_sum"], row["groups_sha256"]) == (0, 0, 0, 0, "")


def test_pair_bound(spark, docs_of):
    both = align.pair(*align.default_paths())
    assert 10_000 < both.pair_bound() < 1_000_000
    found = align.aligned(docs_of(list(enumerate(TEXTS))))
    lens = both.a_spelling.lens, both.b_spelling.lens
    for r in align.pair_counts(found).collect():
        x, y = (s.bytes[s.at[i] : s.at[i] + s.lens[i]].tobytes() for s, i in ((both.a_spelling, r["a"]), (both.b_spelling, r["b"])))
        assert x.endswith(y) or y.endswith(x)
    assert lens[0].min() >= 1


def test_ranks_equal_the_tokenizer():
    """Merging by rank gives the ids of the tokenizer itself, and very long blanks do not reach its pattern."""
    both = align.pair(*align.default_paths())
    assert both.ranks is not None
    texts = [*TEXTS, "a" + " " * 200_000 + "b", "\n" * 50_000, "x" * 100_000, "don't they'll I'VE 123abc!!! \u2003wide\u3000"]
    rng = random.Random(8)
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), rng.randrange(0x1F300, 0x1F700), 32, 10])) for _ in range(60)) for _ in range(400)]
    for t in texts:
        if t:
            assert both.a_ids(" " + t) == both.a.encode(" " + t, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [1, 3])
def test_parts_do_not_matter(spark, docs_of, size):
    """However many rows a batch holds, the result is the same."""
    rows = list(enumerate(TEXTS))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
        check(align.alignment(docs_of(rows).coalesce(1)), rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
