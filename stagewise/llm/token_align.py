"""Alignment of two tokenizers' tokens of the same text by diagonal run skipping (op 11).

Both token sequences of a text are reduced to arrays of byte offsets at which their
tokens end. At an index shift ``j - i`` the two arrays agree over a whole stretch of
one-to-one tokens; the stretch is found by comparing slices of 1, 2, 4, ... elements
(and halving again at the first difference), so its cost grows with the logarithm of
its length in steps. Where the ends differ, the two offsets are advanced locally until
they meet; the tokens passed form one irregular group, and the shift is updated.

Corpus-wide counts of linked id pairs are computed per chunk of documents: a worker
writes each chunk's distinct pairs once, with the number of its documents that hold
them, and each document's links as positions in that list. Only the chunks' lists are
summed and joined, so a pair that every document holds is one row a chunk.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .best_fit import _merge_order_encoding
from .common import LONG_BLANKS, materialize, ship_package

#: A chunk is closed at this many documents or links; a larger document is a chunk of its own.
CHUNK_DOCS = 2048
CHUNK_LINKS = 1 << 20

_HEX_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>\Z")


def byte_table(path: str) -> dict[int, bytes]:
    """Id -> bytes of a byte-level BPE vocabulary file of ``tokenizers``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown}
    byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {t["id"] for t in spec.get("added_tokens", [])}
    return {i: w.encode() if i in special else bytes(byte[c] for c in w) for w, i in spec["model"]["vocab"].items()}


def piece_bytes(piece: str) -> bytes:
    """Bytes of a sentencepiece piece: U+2581 is a blank, ``<0xHH>`` one byte."""
    m = _HEX_PIECE.match(piece)
    return bytes([int(m[1], 16)]) if m else piece.replace("▁", " ").encode()


class _Both:
    """Both tokenizers with the bytes of their ids. The byte-level vocabulary is encoded by
    tiktoken where its ids follow its merges (same ids, faster), else by ``tokenizers``."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        by_id = byte_table(path_a)
        self.bytes_a = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [piece_bytes(self.sp.id_to_piece(i)) for i in range(self.sp.get_piece_size())]
        self.quick, self.slow, self.path_a = _merge_order_encoding(path_a), None, path_a
        self.lens_a, self.lens_b = (np.array([len(t) for t in bs], np.int64) for bs in (self.bytes_a, self.bytes_b))
        pieces = [f"{i}{end}".encode() for n, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;"))
                  for end in ends for i in range(n)]
        chars = np.array(pieces)  # fixed width, filled up with zero bytes
        self.chars = chars.view(np.uint8).reshape(len(pieces), -1)

    def encode_a(self, text: str) -> list[int]:
        if self.quick and not LONG_BLANKS.search(text):
            return self.quick.encode_ordinary(text)
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path_a)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None):
        """``(ids a, ends a, ids b, ends b)`` of blank + text as numpy arrays; None if it has no tokens by the contract."""
        if not text:
            return None
        a, b, whole = self.encode_a(" " + text), self.sp.encode(text), b" " + text.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return a, np.cumsum(self.lens_a[a]), b, np.cumsum(self.lens_b[b])

    def groups_text(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3`` of the groups that end before the given indices."""
        # each token's place in the text: those of its own side before it, and the other side's groups before its own
        at = np.empty(len(a) + len(b), np.int64)
        size_a, size_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
        place_a, place_b = np.repeat(cuts_b - size_b, size_a), np.repeat(cuts_a, size_b)
        place_a += np.arange(len(a))
        place_b += np.arange(len(b))
        at[place_a] = a
        at[place_b] = b + 2 * len(self.bytes_a)
        at[place_a[cuts_a - 1]] += len(self.bytes_a)
        at[place_b[cuts_b - 1]] += len(self.bytes_b)
        text = self.chars[at].ravel()
        return text[text != 0][:-1].tobytes()


def stretches(ends_a: list[int], ends_b: list[int]) -> list[int]:
    """Cuts two strictly increasing end arrays with the same last value into stretches.

    Returns half-open index ranges ``from a, to a, from b, to b``, one after the other: either
    one-to-one stretches (ranges of equal length, every end equal) or single
    irregular groups (more than one token on at least one side, equal only in
    their last end). A range of one token on both sides is one-to-one."""
    out: list[int] = []
    i = j = 0
    n = len(ends_a)
    while i < n:
        x, y = ends_a[i], ends_b[j]
        if x == y:
            i0, j0, width, grow = i, j, 1, True
            while width and i < n:
                part = ends_a[i:i + width]
                if part == ends_b[j:j + width]:
                    i += len(part)
                    j += len(part)
                    width = 2 * width if grow else width >> 1
                else:
                    grow = False
                    width >>= 1
            out += (i0, i, j0, j)
            if i >= n:
                break
            x, y = ends_a[i], ends_b[j]
        i0, j0 = i, j
        while x != y:
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
        i += 1
        j += 1
        out += (i0, i, j0, j)
    return out


def cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exclusive ends of the groups, as indices into both token arrays."""
    found = np.array(stretches(ends_a.tolist(), ends_b.tolist()), np.int64).reshape(-1, 4)
    a0, a1, b0, b1 = found.T
    plain = (a1 - a0 == b1 - b0) & (ends_a[a0] == ends_b[b0])
    n = np.where(plain, a1 - a0, 1)
    back = np.repeat(np.cumsum(n), n) - np.arange(n.sum()) - 1  # groups of the stretch that follow this one
    return np.repeat(a1, n) - back, np.repeat(b1, n) - back


def links(ends_a: np.ndarray, ends_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of all tokens whose byte ranges overlap.

    In a one-to-one group that is its pair; a walk through an irregular group,
    always past the token that ends first, meets each of its pairs once."""
    size_a, size_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
    odd = (size_a > 1) | (size_b > 1)
    in_a, in_b = np.repeat(odd, size_a), np.repeat(odd, size_b)
    i, j = np.flatnonzero(in_a), np.flatnonzero(in_b)
    inner = np.union1d(ends_a[i], ends_b[j])  # each byte offset where a walk takes a step
    step_a, step_b = i[np.searchsorted(ends_a[i], inner)], j[np.searchsorted(ends_b[j], inner)]
    return np.concatenate([cuts_a[~odd] - 1, step_a]), np.concatenate([cuts_b[~odd] - 1, step_b])


_DOC = T.StructType([
    T.StructField("chunk", T.LongType()), T.StructField("is_doc", T.BooleanType()), T.StructField("doc_id", T.LongType()),
    T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
    T.StructField("n_links", T.LongType()), T.StructField("groups_sha256", T.StringType()),
    T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(T.IntegerType())),
    T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("docs", T.ArrayType(T.IntegerType())),
])
_DOC_ARROW = pa.schema([
    ("chunk", pa.int64()), ("is_doc", pa.bool_()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("places", pa.list_(pa.int32())),
    ("times", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32())),
])
_TABLES: dict[tuple[str, str], _Both] = {}


def _chunk_batch(chunk: int, docs: list[tuple]) -> pa.RecordBatch:
    """Rows of one chunk: its documents, links as places in the chunk's list of pairs, and that list."""
    pairs, docs_of = np.unique(np.concatenate([d[6] for d in docs]), return_counts=True)
    rows = [(chunk, True, *d[:6], np.searchsorted(pairs, d[6]).astype(np.int32), d[7], None, None) for d in docs]
    rows.append((chunk, False, *[None] * 8, pairs, docs_of.astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _DOC_ARROW)], schema=_DOC_ARROW)


def aligned_chunks(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Every document's alignment, in chunks; see ``_DOC``. Chunk numbers hold the
    partition's, so a task that runs again writes the same ones."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        both = _TABLES.get((tokenizer_a, tokenizer_b))
        if both is None:
            both = _TABLES[tokenizer_a, tokenizer_b] = _Both(tokenizer_a, tokenizer_b)
        chunk = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        n_links = 0
        for batch in batches:
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = both.encode(t.as_py())
                if tokens is None:
                    row = (doc, 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32))
                else:
                    a, ends_a, b, ends_b = tokens
                    cuts_a, cuts_b = cuts(ends_a, ends_b)
                    i, j = links(ends_a, ends_b, cuts_a, cuts_b)
                    pairs, times = np.unique((a[i] << 32) | b[j], return_counts=True)
                    digest = hashlib.sha256(both.groups_text(a, b, cuts_a, cuts_b)).hexdigest()
                    row = (doc, len(a), len(b), len(cuts_a), len(i), digest, pairs, times.astype(np.int32))
                if held and (len(held) >= CHUNK_DOCS or n_links + len(row[6]) > CHUNK_LINKS):
                    yield _chunk_batch(chunk, held)
                    chunk, held, n_links = chunk + 1, [], 0
                held.append(row)
                n_links += len(row[6])
        if held:
            yield _chunk_batch(chunk, held)

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("t")).mapInArrow(run, _DOC)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``(pair, n, best)``: documents that hold a linked pair (``a id << 32 | b id``), and
    whether no pair of its A id is held by more. A window's partition is one A id's
    pairs, at most the size of B's vocabulary."""
    lists = chunks.where(~F.col("is_doc")).select(F.explode(F.arrays_zip("pairs", "docs")).alias("x"))
    counts = lists.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("n"))
    top = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.withColumn("best", F.col("n") == top)


_OUT = T.StructType([T.StructField(n, T.StringType() if n == "groups_sha256" else T.LongType()) for n in (
    "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")])


def align_documents(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: numbers of tokens, groups and links, ``n_best`` (links whose
    pair is held by as many documents as any pair of its A id), ``count_sum`` (of
    the pair's documents over the links) and the SHA-256 of the groups.

    Tokenizer A (a byte-level BPE file of ``tokenizers``) encodes blank + text,
    B (a sentencepiece model) the text; special tokens' strings are plain text.
    Both paths must exist on every executor. A text that is NULL, empty or not
    given back byte for byte by both has no tokens: zeros and an empty digest.
    Repeated rows and ids each count as a document; NULL ids are kept. An empty
    table gives no rows. Other columns aren't read."""
    chunks = materialize(aligned_chunks(docs, tokenizer_a, tokenizer_b, doc_id, text), "aligned")
    lists = chunks.where(~F.col("is_doc")).select("chunk", F.explode("pairs").alias("pair"))
    counted = lists.join(pair_counts(chunks), "pair").select(F.col("chunk").alias("of"), "pair", "n", "best")
    rows = chunks.where("is_doc").select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pair").to_numpy())
        n = right.column("n").to_numpy()[order]
        best = right.column("best").to_numpy(zero_copy_only=False)[order]
        places, times = left.column("places").combine_chunks(), left.column("times").combine_chunks()
        at, t = places.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        ends = np.cumsum(places.value_lengths().to_numpy())
        sums = [np.concatenate([[0], np.cumsum(v)]) for v in (t * best[at], t * n[at])]
        n_best, count_sum = (s[ends] - s[np.concatenate([[0], ends[:-1]])] for s in sums)
        out = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        out = out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
        return out.append_column("groups_sha256", left.column("groups_sha256"))

    return rows.groupBy("chunk").cogroup(counted.groupBy("of")).applyInArrow(finish, _OUT)
