"""Ranked lexical search by Block-Max MaxScore over an index sharded by document (op 13).

``build_index`` writes one table. Each task cuts its documents into shards of bounded
size and writes, for every term of a shard, one row with the term's posting list in
compressed blocks. A block's bound is kept as the pairs (occurrences, document length)
that no other posting of it beats in both, so bounds don't depend on corpus
statistics: shards can be added, and the score's parameters are applied when searching.

``search`` reads the rows of the queries' terms only, shuffled by shard. Within a shard,
documents are ranked a window at a time. The bounds of whole lists split a query's lists:
those of the lowest bounds, which together can't reach the current k-th score, are
non-essential. Only documents of essential lists are candidates; on the other lists,
the maximum of the block that would hold a candidate rejects it before the block is
decompressed. A task keeps one heap a query over its shards, and the heaps are merged.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_materialized, materialize, ship_package, text_or_empty

K = 10
#: A shard is closed at this many bytes of text; a longer text is a shard of its own.
SHARD_BYTES = 16 << 20
#: Postings in a block, documents ranked at a time, and bytes of queries that one pass over the index takes.
BLOCK = 128
WINDOW = 1024
QUERY_BYTES = 2 << 20
#: Fixed values of the score.
SCALE, LENGTH_SHARE = 1_000_000_000, 90

#: Every ASCII character but digits and letters separates terms; A-Z are lower-cased.
_TO_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, in UTF-8."""
    return text.encode().translate(_TO_TERMS).split() if text else []


INDEX = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("term", T.BinaryType()), T.StructField("df", T.IntegerType()),
    T.StructField("last", T.ArrayType(T.IntegerType())), T.StructField("widths", T.BinaryType()),
    T.StructField("n_pairs", T.ArrayType(T.IntegerType())), T.StructField("pair_tf", T.ArrayType(T.IntegerType())),
    T.StructField("pair_len", T.ArrayType(T.IntegerType())), T.StructField("postings", T.BinaryType()),
    T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("lens", T.ArrayType(T.IntegerType())),
])
_LISTS = {"last": pa.int32(), "n_pairs": pa.int32(), "pair_tf": pa.int32(), "pair_len": pa.int32(), "ids": pa.int64(), "lens": pa.int32()}
_KINDS = {"shard": pa.int64(), "df": pa.int32(), **{k: pa.list_(v) for k, v in _LISTS.items()}}
_INDEX_ARROW = pa.schema([(n, _KINDS.get(n, pa.binary())) for n in INDEX.names])


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Start of each part, and the end of the last."""
    return np.concatenate([[0], np.cumsum(sizes)])


def _width(top: np.ndarray) -> np.ndarray:
    return np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4))


def pack_postings(term_of: np.ndarray, doc: np.ndarray, tf: np.ndarray, lens: np.ndarray) -> dict[str, np.ndarray]:
    """Posting lists in blocks. Postings are sorted by term (0, 1, ...), then document.

    A block is its documents' gaps (the first from the last document of the
    block before, or from -1), then their occurrences, each in 1, 2 or 4 bytes as its largest
    value needs. All arrays are flat; ``blocks`` and ``bytes`` give their ends by term."""
    df = np.bincount(term_of)
    first = _starts(df)[:-1]
    rank = np.arange(len(doc)) - first[term_of]
    starts = np.flatnonzero(rank % BLOCK == 0)  # of blocks
    sizes = np.diff(np.append(starts, len(doc)))
    block_of = np.repeat(np.arange(len(starts)), sizes)
    gap = np.diff(doc, prepend=0)
    gap[first] = doc[first] + 1
    w_gap, w_tf = _width(np.maximum.reduceat(gap, starts)), _width(np.maximum.reduceat(tf, starts))
    block_at = _starts(sizes * (w_gap + w_tf))
    out = np.zeros(block_at[-1], np.uint8)
    within = np.arange(len(doc)) - starts[block_of]
    for values, widths, base in ((gap, w_gap, block_at[:-1]), (tf, w_tf, block_at[:-1] + sizes * w_gap)):
        for w in (1, 2, 4):
            pick = np.flatnonzero((widths == w)[block_of])
            if len(pick):
                at = base[block_of[pick]] + within[pick] * w
                out[at[:, None] + np.arange(w)] = values[pick].astype(f"<u{w}").view(np.uint8).reshape(-1, w)
    # pairs that no posting of the block beats: by length, those with more occurrences than any before
    n = lens[doc]
    order = np.lexsort((-tf, n, block_of))
    rising = block_of[order] * (int(tf.max()) + 1) + tf[order]
    kept = order[rising > np.concatenate([[-1], np.maximum.accumulate(rising)[:-1]])]
    of_term = term_of[starts]
    return {
        "df": df, "last": doc[starts + sizes - 1], "widths": (w_gap * 16 + w_tf).astype(np.uint8),
        "n_pairs": np.bincount(block_of[kept], minlength=len(starts)), "pair_tf": tf[kept], "pair_len": n[kept], "postings": out,
        "blocks": np.cumsum(np.bincount(of_term)), "pairs": np.cumsum(np.bincount(term_of[kept])),
        "bytes": np.cumsum(np.bincount(of_term, np.diff(block_at)).astype(np.int64)),
    }


def unpack_block(data: np.ndarray, n: int, widths: int, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and occurrences of a block of ``n`` postings; ``before`` is the last document of the block before, or -1."""
    w_gap, w_tf = widths >> 4, widths & 15
    gap = data[:n * w_gap].view(f"<u{w_gap}").astype(np.int64)
    return before + np.cumsum(gap), data[n * w_gap:n * (w_gap + w_tf)].view(f"<u{w_tf}").astype(np.int64)


def _shard_batches(shard: int, ids: list, found: list[tuple[np.ndarray, np.ndarray]], vocabulary: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Rows of one shard: first its documents (no term), then a row a term."""
    lens = np.array([int(c.sum()) for _, c in found], np.int64)
    own = pa.RecordBatch.from_pylist([{"shard": shard, "ids": ids, "lens": lens.tolist()}], schema=_INDEX_ARROW)
    yield own
    if not vocabulary:
        return
    term = np.concatenate([t for t, _ in found])
    doc = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])
    order = np.argsort(term, kind="stable")
    p = pack_postings(term[order], doc[order], np.concatenate([c for _, c in found])[order], lens)
    by_block, by_pair = _starts(np.diff(p["blocks"], prepend=0)), _starts(np.diff(p["pairs"], prepend=0))

    def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))

    def blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])

    v = len(vocabulary)
    cols = {
        "shard": pa.array(np.full(v, shard), pa.int64()), "term": pa.array(vocabulary, pa.binary()),
        "df": pa.array(p["df"], pa.int32()), "last": lists(p["last"], by_block, pa.int32()),
        "widths": blobs(p["widths"], by_block), "n_pairs": lists(p["n_pairs"], by_block, pa.int32()),
        "pair_tf": lists(p["pair_tf"], by_pair, pa.int32()), "pair_len": lists(p["pair_len"], by_pair, pa.int32()),
        "postings": blobs(p["postings"], np.concatenate([[0], p["bytes"]])),
        "ids": pa.nulls(v, pa.list_(pa.int64())), "lens": pa.nulls(v, pa.list_(pa.int32())),
    }
    batch = pa.RecordBatch.from_arrays([cols[n] for n in _INDEX_ARROW.names], schema=_INDEX_ARROW)
    for at in range(0, v, 1 << 14):
        yield batch.slice(at, 1 << 14)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of all documents, written to the shared scratch folder (``INDEX``).

    A document without terms has length 0 and no postings. A shard's number
    holds its partition's, so a task that runs again writes the same shards."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        ids, found, size = [], [], 0
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms(t.as_py())
                ids.append(i)
                found.append(np.unique(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), return_counts=True))
                size += 16 + sum(map(len, words)) + len(words)
                if size >= shard_bytes:
                    yield from _shard_batches(shard, ids, found, list(numbers))
                    shard, ids, found, size = shard + 1, [], [], 0
                    numbers.clear()
        if ids:
            yield from _shard_batches(shard, ids, found, list(numbers))

    d = docs.select(F.col(doc_id).cast("bigint").alias("i"), text_or_empty(text).alias("t"))
    return materialize(d.mapInArrow(run, INDEX), "search-index")


class Scoring:
    """Corpus statistics and the integer score made of them."""

    def __init__(self, documents: int, length: int):
        self.documents, self.length = documents, length

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))

    def norms(self, lens: np.ndarray) -> np.ndarray:
        """The length part m of each document."""
        if len(lens) and int(lens.max()) * self.documents * LENGTH_SHARE >= 1 << 63:
            return np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(n) * self.documents // self.length for n in lens], np.int64)
        return 100 - LENGTH_SHARE + LENGTH_SHARE * lens * self.documents // max(self.length, 1)

    @staticmethod
    def part(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """What one term's occurrences are worth, before its weight; grows with ``tf``, falls with ``norm``."""
        return SCALE * tf // (1000 * tf + 8 * norm)


class Postings:
    """One term's list in a shard; blocks are decompressed when asked for and kept while the shard is searched."""

    def __init__(self, row: dict, norms: np.ndarray, scoring: Scoring):
        self.last = np.array(row["last"], np.int64)
        self.norms = norms
        n = len(self.last)
        self.sizes = np.full(n, BLOCK)
        self.sizes[-1] = row["df"] - BLOCK * (n - 1)
        self.widths = np.frombuffer(row["widths"], np.uint8).astype(np.int64)
        self.data = np.frombuffer(row["postings"], np.uint8)
        self.at = _starts(self.sizes * ((self.widths >> 4) + (self.widths & 15)))
        parts = scoring.part(np.array(row["pair_tf"], np.int64), scoring.norms(np.array(row["pair_len"], np.int64)))
        self.top = np.maximum.reduceat(parts, _starts(np.array(row["n_pairs"]))[:-1])  # of each block
        self.most = int(self.top.max())
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and parts of a block."""
        got = self.open.get(k)
        if got is None:
            before = int(self.last[k - 1]) if k else -1
            doc, tf = unpack_block(self.data[self.at[k]:self.at[k + 1]], int(self.sizes[k]), int(self.widths[k]), before)
            got = self.open[k] = doc, Scoring.part(tf, self.norms[doc])
        return got

    def span(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``start`` to before ``end``, and their parts."""
        a, b = np.searchsorted(self.last, [start, end - 1])
        parts = [self.block(k) for k in range(int(a), min(int(b) + 1, len(self.last)))]
        if not parts:
            return self.last[:0], self.last[:0]
        doc, part = (np.concatenate(x) for x in zip(*parts)) if len(parts) > 1 else parts[0]
        lo, hi = np.searchsorted(doc, [start, end])
        return doc[lo:hi], part[lo:hi]


class Best:
    """A query's best ``k`` documents so far: higher scores first, then smaller ids (none last)."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """Smallest score that may still get in; equal scores may, as their ids decide."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        score, ids, null = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.null, null)))
        order = np.lexsort((ids, null, -score))[:self.k]
        self.score, self.id, self.null = score[order], ids[order], null[order]


def rank_window(lists: list[tuple[int, int, Postings]], start: int, end: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the window that score ``least`` or more, with their scores.

    ``lists``: ``(bound, weight, postings)`` of the query's terms, by rising bound."""
    reach = np.cumsum([b for b, _, _ in lists])
    first = int(np.searchsorted(reach, least))  # lists before it can't reach `least` together
    score = np.zeros(end - start, np.int64)
    for _, weight, postings in lists[first:]:
        doc, part = postings.span(start, end)
        score[doc - start] += weight * part
    doc = np.flatnonzero(score)
    score = score[doc]
    doc += start
    for t in range(first - 1, -1, -1):
        alive = score + reach[t] >= least
        doc, score = doc[alive], score[alive]
        if not len(doc):
            return doc, score
        _, weight, postings = lists[t]
        block = np.searchsorted(postings.last, doc)
        inside = block < len(postings.last)
        most = np.where(inside, weight * postings.top[np.minimum(block, len(postings.last) - 1)], 0)
        alive = score + most + (reach[t - 1] if t else 0) >= least
        doc, score, block, inside = doc[alive], score[alive], block[alive], inside[alive]
        cut = np.flatnonzero(np.diff(block, prepend=-1))  # documents and so blocks rise
        for a, b in zip(cut, np.append(cut[1:], len(block))):
            if inside[a]:
                held, part = postings.block(int(block[a]))
                at = np.searchsorted(held, doc[a:b])  # the block's last document is not before them
                score[a:b] += np.where(held[at] == doc[a:b], weight * part[at], 0)
    alive = score >= least
    return doc[alive], score[alive]


_HIT = T.StructType([T.StructField("query", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])


def _search_block(index: DataFrame, queries: list[list[bytes]], first: int, k: int, scoring: Scoring, shards: int) -> DataFrame:
    """Best ``k`` documents of each task's shards for queries ``first``, ``first + 1``, ..."""
    spark = index.sparkSession
    wanted = sorted({t for q in queries for t in q})
    vocabulary = F.broadcast(spark.createDataFrame([(t,) for t in wanted], "term binary"))  # of at most QUERY_BYTES, or one query
    rows = index.where(F.col("term").isNotNull()).join(vocabulary, "term")
    weights = {bytes(r["term"]): scoring.weight(r["n"]) for r in rows.groupBy("term").agg(F.sum("df").alias("n")).collect()}
    plans = [[(t, weights[t]) for t in q if weights.get(t)] for q in queries]

    def best_of(shard: dict[bytes, dict], own: dict, heaps: list[Best]) -> None:
        lens = np.array(own["lens"], np.int64)
        norms = scoring.norms(lens)
        null = np.array([i is None for i in own["ids"]], bool)
        ids = np.array([0 if i is None else i for i in own["ids"]], np.int64)
        postings = {t: Postings(r, norms, scoring) for t, r in shard.items()}
        for plan, heap in zip(plans, heaps):
            lists = sorted(((w * postings[t].most, w, postings[t]) for t, w in plan if t in postings), key=lambda x: x[0])
            for start in range(0, len(lens) if lists else 0, WINDOW):
                if sum(b for b, _, _ in lists) < heap.least:
                    break
                doc, score = rank_window(lists, start, min(start + WINDOW, len(lens)), heap.least)
                if len(doc):
                    heap.add(score, ids[doc], null[doc])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = [Best(k) for _ in plans]
        at, shard, own = None, {}, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != at:
                    if own:
                        best_of(shard, own, heaps)
                    at, shard, own = row["shard"], {}, None
                if row["term"] is None:
                    own = row
                else:
                    shard[row["term"]] = row
        if own:
            best_of(shard, own, heaps)
        hits = [(first + q, None if n else int(i), int(s)) for q, h in enumerate(heaps) for s, i, n in zip(h.score, h.id, h.null)]
        cols = list(zip(*hits)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], _HIT.names)

    ship_package(spark)
    parts = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    both = rows.select(*INDEX.names).unionByName(index.where(F.col("term").isNull()))
    return both.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(run, _HIT)


def search(index: DataFrame, queries: DataFrame, k: int = K, item_id: str = "item_id", text: str = "text",
           query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each query's ``k`` best documents with a score above 0.

    Queries come to the driver in blocks of ``query_bytes`` (a longer one alone), and every block
    takes one pass over its terms' rows of the index. Each row of ``queries`` is an item of its own, also with a NULL
    or repeated id; one without terms, or an empty index, gives no rows. Equal scores rank by smaller ``doc_id``, none last."""
    spark = index.sparkSession
    stats = index.where(F.col("term").isNull()).agg(
        F.count(F.lit(1)).alias("shards"),
        F.sum(F.aggregate("lens", F.lit(0).cast("bigint"), lambda s, n: s + n)).alias("length"),
        F.sum(F.size(F.filter("lens", lambda n: n > 0))).alias("documents"),
    ).first()
    scoring = Scoring(stats["documents"] or 0, stats["length"] or 0)
    items = materialize(queries.select(F.col(item_id).alias("item_id"), F.col(text).alias("t")), "queries")
    names, parts = [], []

    def flush(block: list[list[bytes]], first: int) -> None:
        if any(block):
            parts.append(materialize(_search_block(index, block, first, k, scoring, stats["shards"]), "hits"))

    block, size, first = [], 0, 0
    for r in items.toLocalIterator():
        words = list(dict.fromkeys(terms(r["t"])))
        n = sum(map(len, words))
        if block and size + n > query_bytes:
            flush(block, first)
            first, block, size = first + len(block), [], 0
        names.append((len(names), r["item_id"]))
        block.append(words)
        size += n
    if block:
        flush(block, first)
    named = spark.createDataFrame(names, T.StructType([T.StructField("query", T.LongType()), T.StructField("item_id", items.schema["item_id"].dataType)]))
    hits = spark.createDataFrame([], _HIT)
    for p in parts:
        hits = hits.unionByName(p)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    drop_materialized(items)
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).join(named, "query").select("item_id", "rank", "doc_id", "score")


def search_documents(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """The index of ``docs`` searched for ``queries``; NULL texts have no terms, other columns aren't read."""
    return search(build_index(docs), queries, k)
