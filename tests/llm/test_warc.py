import io
import zlib

import pytest

from tidemark.llm import warc as op
from tidemark.session import scratch_path


def test_sql(same_as_sql):
    same_as_sql("op8_warc")


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 7) for i, u, h in rows], "page_id long, url string, html string, file string, first long")


ROWS = [(1, "http://a.example/x y\r\nz", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "u", None), (4, "u", ""), (5, "u", "é\0\r\n\r\nWARC/1.1\r\n" * 9),
        (None, "u", "<p>one</p>"), (None, "u", "null only"), (6, "u", "twice"), (6, "u", "twice"), (7, "u", "long " * 400_000)]


def test_round_trip_of_payloads(spark):
    back = op.read_archives(op.write_archives(pages(spark, ROWS), scratch_path(spark, "t")), payloads=True).collect()
    assert len(back) == len(ROWS)
    by = {}
    for r in back:
        by.setdefault(r["page_id"], []).append(r)
    want = {str(i): h or "" for i, _, h in ROWS if i is not None}
    for i, h in want.items():
        for r in by[i]:
            assert r["payload_bytes"] == len(h.encode())
            if r["record_type"] == "response":
                assert bytes(r["payload"]) == h.encode()
    kinds = {i: [(r["record_type"], r["refers_to"]) for r in by[i]] for i in want}
    assert kinds["1"] == [("revisit", "2")] and kinds["2"] == [("response", None)]
    assert kinds["3"] == [("revisit", "4")] and kinds["4"] == [("response", None)] and kinds["6"] == [("response", None)] * 2
    assert sorted((r["record_type"], r["refers_to"]) for r in by[None]) == [("response", None), ("revisit", "2")]


def test_small_payloads_are_all_responses(spark):
    back = op.read_archives(op.write_archives(pages(spark, [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "a" * 50), (4, "u", "a" * 50)]),
                                              scratch_path(spark, "t"), least=10)).collect()
    assert {r["page_id"]: r["record_type"] for r in back} == {"1": "response", "2": "response", "3": "revisit", "4": "response"}


def test_empty_table(spark):
    manifest = op.write_archives(pages(spark, []), scratch_path(spark, "t"))
    assert manifest.count() == 0 and op.read_archives(manifest).count() == 0


def archive(*records):
    return b"".join(records)


def one(n=1, payload=b"hello"):
    return op.page_record(n, "u", payload, op.b32(__import__("hashlib").sha1(payload).digest()), None)


@pytest.mark.parametrize("size", [1, 7, 100, 1 << 16])
def test_reader_at_any_read_size(size, monkeypatch):
    data = archive(*[one(i, b"x" * (i * 37)) for i in range(30)])
    monkeypatch.setattr(op.Members.__init__, "__defaults__", (size,))
    got = list(op.read_records(io.BytesIO(data), payloads=True))
    assert [len(r["payload"]) for r in got] == [i * 37 for i in range(30)]


def member(text: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(text) + z.flush()


def test_damage_is_found():
    plain = zlib.decompress(one(), 31)
    cases = [member(plain.replace(b"hello", b"hullo")), member(plain[:-4]), member(plain + b"more"), one()[:-9],
             member(plain.replace(b"WARC/1.1", b"WARC/9.9", 1)), member(plain + plain), member(plain.replace(b"Content-Length: ", b"Content-Length: 9", 1))]
    for data in cases:
        with pytest.raises((ValueError, KeyError)):
            list(op.read_records(io.BytesIO(one() + data)))
    assert len(list(op.read_records(io.BytesIO(one() + one(2))))) == 2
