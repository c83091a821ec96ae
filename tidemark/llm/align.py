"""Operator 12: cross-tokenizer alignment, in Arrow from end to end.

Every text, with a space before it, is encoded by a byte-level BPE (A) and by a piece
model with byte fallback (B).  The ids of a batch lie in two list columns; they are
flattened with their parent indices, the token lengths are summed along each document, and
a hash join on (document, end) finds the places where tokens of both end.  These
cut a document into groups, and every pair met there is a link.

Links are written once, as two list columns per document.  Each task counts its pairs with
``Table.group_by``, Spark adds the counts up, and a second pass joins them back to
the links.  Two tokens that end together cover the same last bytes, so one is a suffix
of the other: a vocabulary of A and one of B allow no more pairs than their tokens have
bytes together (``pair_bound``).  Only that table, whose size the vocabularies bound
whatever the corpus, is broadcast.

Defined cases: null and empty texts, and texts that the tokens of A or B do not spell back
(normalised characters), have no tokens, so all counts are zero and ``groups_sha256`` is
empty; a null doc_id is a document like others; repeated rows are aligned and counted one by one; an empty table gives
an empty result; other columns are ignored.  A task holds about a megabyte of text, or one text where that is longer.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read, release, stage
from tidemark.llm.fill_middle import row_parts

#: How a piece writes a byte, and a space.
BYTE_PIECE, SPACE_PIECE = re.compile("<0x([0-9A-F]{2})>"), "▁"
LONG_BLANK = re.compile(r"\s{1000}")
#: Links that a task joins with the counts at once.
LINKS = 1 << 19


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1
    characters stand for themselves, the other bytes in ascending order for code points from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)).difference(visible))
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Spelling:
    """Bytes of tokens by id."""

    def __init__(self, tokens: list[bytes]):
        self.lens = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.lens) - self.lens
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        lens = self.lens[ids]
        first = np.cumsum(lens) - lens
        return self.bytes[np.repeat(self.at[ids] - first, lens) + np.arange(int(lens.sum()))].tobytes()


def rank_encoder(tokenizer, spelled: dict[bytes, int]):
    """Merging by rank with the vocabulary of ``tokenizer``, several times as fast as its own merging; None
    where the two might differ.

    They agree where texts are split alike and every entry's own text is merged to that entry: then adjacent tokens that
    spell an entry are always a listed pair, so both join the same pairs in the same order."""
    import json

    import public_tokenizers
    import tiktoken

    own = json.loads(tokenizer.to_str())
    split = own["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not own["normalizer"]
    special = {t["id"] for t in own["added_tokens"]}
    entries = {s: i for s, i in tokenizer.get_vocab(with_added_tokens=False).items() if i not in special}
    if not plain or any([t.id for t in tokenizer.model.tokenize(s)] != [i] for s, i in entries.items()):
        return None
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks={b: i for b, i in spelled.items() if i not in special})


class Pair:
    """The two tokenizers and the spelling of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = byte_alphabet()
        names = {i: s for s, i in self.a.get_vocab(with_added_tokens=True).items()}
        spell = lambda s: bytes(byte[c] for c in s) if all(c in byte for c in s) else s.encode()
        tokens = [spell(names.get(i, "")) for i in range(max(names) + 1)]
        self.a_spelling = Spelling(tokens)
        self.ranks = rank_encoder(self.a, {t: i for i, t in enumerate(tokens)})
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_spelling = Spelling([bytes([int(m[1], 16)]) if (m := BYTE_PIECE.fullmatch(p)) else p.replace(SPACE_PIECE, " ").encode() for p in pieces])

    def pair_bound(self) -> int:
        """Most pairs that can end together in any corpus."""
        return int(self.a_spelling.lens.sum() + self.b_spelling.lens.sum())

    def a_ids(self, text: str) -> list[int]:
        """Ids by A; the rank encoder's pattern takes no very long runs of white space."""
        if self.ranks is None or LONG_BLANK.search(text):
            return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return self.ranks.encode_ordinary(text)

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of every text by A and by B; both lists are empty where either does not spell the text back."""
        some = [i for i, t in enumerate(texts) if t]
        a = [self.a_ids(" " + texts[i]) for i in some]
        b = self.b.encode([texts[i] for i in some], num_threads=1)
        left, right = [[]] * len(texts), [[]] * len(texts)
        for i, x, y in zip(some, a, b):
            want = b" " + texts[i].encode()
            if self.a_spelling.join(np.array(x, np.int64)) == want and self.b_spelling.join(np.array(y, np.int64)) == want:
                left[i], right[i] = x, y
        kind = pa.list_(pa.int32())
        return pa.array(left, kind), pa.array(right, kind)


@lru_cache(2)
def pair(a_path: str, b_path: str) -> Pair:
    """One per Python worker."""
    return Pair(a_path, b_path)


def token_ends(ids: pa.ListArray, lens: np.ndarray) -> pa.Table:
    """(doc, key, id, pos): tokens of all documents in order; ``key`` is the document and the byte in it at which the token ends."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids).cast(pa.int64())
    size = pc.take(pa.array(lens), flat)
    total = pc.cumulative_sum(size)
    # what the documents before have in all is what their tokens sum to before the first one
    count = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
    sums = np.concatenate(([0], total.to_numpy(zero_copy_only=False))).astype(np.int64)
    base = pa.array(sums[np.cumsum(count) - count])
    end = pc.subtract(total, pc.take(base, doc))
    return pa.table({"doc": doc, "key": pc.add(pc.shift_left(doc, 40), end), "id": flat, "pos": pa.array(np.arange(len(flat)))})


def links(a: pa.Table, b: pa.Table) -> pa.Table:
    """(doc, key, a, b, pos_a, pos_b) of all tokens that end together, in order."""
    met = a.rename_columns(["doc", "key", "a", "pos_a"]).join(
        b.select(["key", "id", "pos"]).rename_columns(["key", "b", "pos_b"]), "key", join_type="inner", use_threads=False)
    return met.sort_by("pos_a").combine_chunks()


def column(table: pa.Table, name: str) -> pa.Array:
    c = table.column(name)
    return c.chunk(0) if c.num_chunks == 1 else pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type)


def cut(values: pa.Array, stops: np.ndarray) -> pa.ListArray:
    """The values as lists that end at ``stops``."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], stops)).astype(np.int32)), values)


def group_texts(met: pa.Table, a_ids: pa.Array, b_ids: pa.Array, per_doc: np.ndarray) -> pa.Array:
    """Per document ``a1,a2|b1;a3|b2,b3``: each group ends with the pair of a link."""
    def side(ids: pa.Array, pos: str) -> pa.Array:
        return pc.binary_join(cut(ids.cast(pa.string()), column(met, pos).to_numpy() + 1), ",")

    groups = pc.binary_join_element_wise(side(a_ids, "pos_a"), side(b_ids, "pos_b"), "|")
    return pc.binary_join(cut(groups, np.cumsum(per_doc)), ";")


def align_batch(doc_ids: pa.Array, a_ids: pa.ListArray, b_ids: pa.ListArray, a_lens: np.ndarray, b_lens: np.ndarray) -> pa.RecordBatch:
    """One row per document: counts, digest of its groups, and its links as two lists."""
    n = len(doc_ids)
    a, b = token_ends(a_ids, a_lens), token_ends(b_ids, b_lens)
    met = links(a, b)
    per_doc = np.bincount(column(met, "doc").to_numpy(), minlength=n)
    texts = group_texts(met, column(a, "id"), column(b, "id"), per_doc)
    digest = [hashlib.sha256(t.as_buffer()).hexdigest() if k else "" for t, k in zip(texts, per_doc.tolist())]
    count = lambda ids: pc.list_value_length(ids).cast(pa.int64())
    stops = np.cumsum(per_doc)
    found = pa.array(per_doc.astype(np.int64))
    return pa.RecordBatch.from_pydict({
        "doc_id": doc_ids, "n_a": count(a_ids), "n_b": count(b_ids), "n_groups": found, "n_links": found,
        "groups_sha256": pa.array(digest, pa.string()),
        "link_a": cut(column(met, "a"), stops), "link_b": cut(column(met, "b"), stops)})


def aligned(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and the links' ids (link_a, link_b) of every row.

    ``paths`` are vocabulary files that every executor can open (installed vocabularies)."""
    kind, paths = dict(docs.dtypes)["doc_id"], paths or default_paths()
    rows = docs.select(F.col("`doc_id`").alias("doc_id"), F.coalesce(F.col("`text`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(*paths)
        for batch in batches:
            for i, j in row_parts(batch.column("text"), 1 << 20) if batch.num_rows else ():
                a, b = both.encode(batch.column("text").slice(i, j - i).to_pylist())
                yield align_batch(batch.column("doc_id").slice(i, j - i), a, b, both.a_spelling.lens, both.b_spelling.lens)
                release()

    return rows.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                "link_a array<int>, link_b array<int>")


def link_table(batch: pa.RecordBatch) -> pa.Table:
    """(row, a, b) of the links in a batch of documents."""
    a, b = batch.column("link_a"), batch.column("link_b")
    return pa.table({"row": pc.list_parent_indices(a).cast(pa.int64()), "a": pc.list_flatten(a), "b": pc.list_flatten(b)})


def link_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``LINKS`` links (a document with more is a part of its own)."""
    for batch in batches:
        if batch.num_rows:
            size = pc.list_value_length(batch.column("link_a")).to_numpy(zero_copy_only=False)
            part = (np.cumsum(size) - size) // LINKS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            yield from (batch.slice(i, j - i) for i, j in zip(cuts, cuts[1:]))


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, n, best): links of each id pair over all documents, and whether none of its b has more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None  # bounded by the vocabularies
        for batch in link_parts(batches):
            part = link_table(batch).group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["a", "b", "n"])
            total = part if total is None else (pa.concat_tables([total, part]).group_by(["a", "b"], use_threads=False)
                                                .aggregate([("n", "sum")]).rename_columns(["a", "b", "n"]))
        if total is not None:
            yield from total.combine_chunks().to_batches(max_chunksize=1 << 16)

    counts = (found.select("link_a", "link_b").mapInArrow(run, "a int, b int, n long")
              .groupBy("a", "b").agg(F.sum("n").alias("n")))
    counts = stage(counts, "pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def with_counts(found: DataFrame, counts: DataFrame) -> DataFrame:
    """``found`` with n_best and count_sum in the place of the links; ``counts`` has at most ``pair_bound`` rows."""
    spark, keep = found.sparkSession, [c for c in found.columns if c not in ("link_a", "link_b")]
    table = spark.sparkContext.broadcast(counts.toArrow().combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value.append_column("one", pc.cast(table.value.column("best"), pa.int64())).select(["a", "b", "n", "one"])
        for batch in link_parts(batches):
            met = link_table(batch).join(known, ["a", "b"], join_type="inner", use_threads=False)
            sums = met.group_by("row", use_threads=False).aggregate([("n", "sum"), ("one", "sum")])
            out = np.zeros((2, batch.num_rows), np.int64)
            for k, c in enumerate(("one_sum", "n_sum")):
                out[k, column(sums, "row").to_numpy()] = column(sums, c).to_numpy()
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in keep}, "n_best": pa.array(out[0]), "count_sum": pa.array(out[1])})
        release()

    kinds = dict(found.dtypes)
    return found.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", n_best long, count_sum long")


def alignment(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum."""
    found = stage(aligned(docs, paths), "links")
    return with_counts(found, pair_counts(found))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(read(spark, sf_dir, "documents"))
