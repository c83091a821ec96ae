"""Operator 8: WARC archives, written from pages and read back sequentially.

Writing: one gzip member per record.  Of pages with equal payloads (of at least
``least`` bytes) the one with the largest page_id is a ``response``; the others
are ``revisit`` records that name it and carry the HTTP header only.  Equal
payloads are found by digest: the digest groups are reduced map-side and only
groups of two or more are joined back (a shuffled join whose hot side adaptive
execution splits).  Each task writes its own files under the shared checkpoint
folder and reports them in a manifest; a repeated task writes new files and only
the manifest of the attempt that succeeded counts.

Reading: per file one sequential pass of incremental decompression.  Every
member must hold one record: header lines, a block of exactly Content-Length
bytes, the closing blank lines, the end of the member.  Block and payload
digests are verified while the bytes pass; memory is bounded by the read size
(and by one payload where payloads are asked for).

Defined cases: null html is an empty payload; a null URL is written as
``urn:unknown``; control characters in a URL are escaped; a null page_id is never chosen
as response of a group that has other ids (a group of null ids only is all
responses); repeated rows with the largest id of their group are all responses;
an empty table gives no archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read, row_cols, stage
from tidemark.session import scratch_path

#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = 1 << 16
ARCHIVE_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"


def b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    head = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", "sha1:" + b32(hashlib.sha1(block).digest())),
            ("Content-Length", str(len(block)))]
    data = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + b"\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def record_id(page_id) -> str:
    return f"<urn:page:{page_id}>"


def page_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """``response`` where ``refers_to`` is None, else ``revisit``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if isinstance(url, str) and url else "urn:unknown"
    own = record_id(page_id) if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"
    fields = [("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", target),
              ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is None:
        return record("response", fields, http + payload)
    return record("revisit", [*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))], http)


class Members:
    """Bytes of a gzip stream, member by member, decompressed as they are read."""

    def __init__(self, f: BinaryIO, size: int = READ):
        self.f, self.size, self.raw, self.buf = f, size, b"", b""
        self.z = None

    def next_member(self) -> bool:
        self.raw = self.raw or self.f.read(self.size)
        self.z, self.buf = zlib.decompressobj(31), b""
        return bool(self.raw)

    def _more(self) -> bool:
        """Some more bytes of the member in ``buf``; False at its end."""
        while not self.z.eof:
            got = self.z.decompress(self.raw, self.size)
            self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if got:
                self.buf += got
                return True
            if not self.z.eof and not self.raw:
                self.raw = self.f.read(self.size)
                if not self.raw:
                    raise ValueError("the archive ends inside a member")
        return False

    def line(self) -> bytes:
        while (at := self.buf.find(b"\r\n")) < 0:
            if len(self.buf) > 1 << 20 or not self._more():
                raise ValueError("no end of line in a record's header")
        out, self.buf = self.buf[:at], self.buf[at + 2 :]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        """Exactly ``n`` bytes, in parts."""
        while n:
            if not self.buf and not self._more():
                raise ValueError("a block is shorter than its Content-Length")
            out, self.buf = self.buf[:n], self.buf[n:]
            n -= len(out)
            yield out

    def end(self) -> None:
        """The blank lines after the block, and then the member's end."""
        if b"".join(self.pieces(4)) != b"\r\n\r\n" or self.buf or self._more():
            raise ValueError("a record does not end where its member ends")


def read_records(f: BinaryIO, payloads: bool = False) -> Iterator[dict]:
    """Records in order, lengths framed and digests verified (a wrong one is an error)."""
    m = Members(f)
    while m.next_member():
        if m.line() != VERSION:
            raise ValueError("a record does not start with the version line")
        head: dict[str, str] = {}
        while (x := m.line()):
            k, _, v = x.decode().partition(":")
            head[k.strip().lower()] = v.strip()
        block, body = hashlib.sha1(), hashlib.sha1()
        http, n_body, kept = b"", 0, []
        inside = not head.get("content-type", "").startswith("application/http")
        for part in m.pieces(int(head["content-length"])):
            block.update(part)
            if not inside:
                http += part
                if (at := http.find(b"\r\n\r\n")) < 0:
                    continue
                http, part, inside = http[: at + 4], http[at + 4 :], True
            body.update(part)
            n_body += len(part)
            if payloads:
                kept.append(part)
        m.end()
        if head.get("warc-block-digest", "").removeprefix("sha1:") != b32(block.digest()):
            raise ValueError(f"block digest of {head.get('warc-record-id')}")
        kind = head["warc-type"]
        if kind == "response" and head["warc-payload-digest"].removeprefix("sha1:") != b32(body.digest()):
            raise ValueError(f"payload digest of {head.get('warc-record-id')}")
        length = re.search(rb"(?i)\r\ncontent-length: *([0-9]+)\r\n", http)
        if kind == "response" and length and int(length[1]) != n_body:
            raise ValueError(f"HTTP length of {head.get('warc-record-id')}")
        yield {"head": head, "type": kind, "payload_bytes": int(length[1]) if length else n_body,
               "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:"),
               "payload": b"".join(kept) if payloads else None}


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write the pages as archives under ``folder`` (a URI that executors can write); the manifest: file, records, bytes."""
    slim = row_cols(pages, "page_id", "url", "html").withColumn("html", F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    slim = slim.withColumn("digest", F.sha1("html"))
    big = F.length("html") >= least
    groups = (slim.filter(big).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
              .filter("n > 1").select("digest", "first"))
    joined = slim.join(stage(groups, "digests"), "digest", "left")
    joined = joined.withColumn("refers_to", F.when(big & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        where, path = fs.FileSystem.from_uri(folder)
        out, name, n, size, done = None, "", 0, 0, []
        where.create_dir(path, recursive=True)
        try:
            for pdf in frames:
                for p, u, h, d, r in zip(pdf["page_id"].astype(object), pdf["url"], pdf["html"], pdf["digest"], pdf["refers_to"].astype(object)):
                    if out is None:
                        name, n = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = where.open_output_stream(f"{path}/{name}")
                        size = out.write(record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                                                             ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    member = page_record(None if pd.isna(p) else p, u, bytes(h), b32(bytes.fromhex(d)), None if pd.isna(r) else r)
                    out.write(member)
                    n, size = n + 1, size + len(member)
                    if size >= ARCHIVE_BYTES:
                        out.close()
                        done.append((f"{folder}/{name}", n, size))
                        out = None
        finally:
            if out is not None:
                out.close()
                done.append((f"{folder}/{name}", n, size))
        if done:
            yield pd.DataFrame(done, columns=["file", "records", "bytes"])

    keep = joined.select("page_id", "url", "html", "digest", "refers_to").withColumn("page_id", F.col("page_id").cast("string")) \
        .withColumn("refers_to", F.col("refers_to").cast("string"))
    return stage(keep.mapInPandas(run, "file string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of the manifest's files, each file read in order by one task (files are of bounded size)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for pdf in frames:
            for file in pdf["file"]:
                where, path = fs.FileSystem.from_uri(file)
                with where.open_input_stream(path) as f:
                    rows = []
                    for r in read_records(f, payloads):
                        if r["type"] == "warcinfo":
                            continue
                        h = r["head"]
                        rows.append((_page(h["warc-record-id"]), h.get("warc-target-uri"), r["payload_bytes"], r["payload_digest"],
                                     r["type"], _page(h.get("warc-refers-to", "")), r["payload"]))
                        if len(rows) >= (64 if payloads else 4096):
                            yield pd.DataFrame(rows, columns=COLUMNS)
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=COLUMNS)

    n = max(1, manifest.count())
    return manifest.select("file").repartition(min(n, 100_000)).mapInPandas(
        run, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary")


COLUMNS = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]


def _page(urn: str):
    return urn[len("<urn:page:") : -1] if urn.startswith("<urn:page:") else None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    kind = dict(pages.dtypes)["page_id"]
    back = read_archives(write_archives(pages, scratch_path(spark, "warc")))
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS first,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (5 * (3 - i % 4))) & 31)::INT, 1) FOR i IN range(32)], '') AS b32 FROM p)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, b32 AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM g
"""
