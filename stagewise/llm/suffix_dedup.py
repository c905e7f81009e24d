"""Exact substring dedup by blockwise suffix sorting with a difference cover (op 5).

A byte is removed if a 200-byte string that covers it also starts anywhere else.

Equal 200-byte strings have the same smallest hash among their k-grams, so they
meet in the bucket of that k-gram (their anchor), at the same distance from it.
Buckets whose anchor occurs once hold no repeat and are never sorted. The others
are sorted a block of buckets at a time: the bytes around each anchor are aligned
on it, the positions whose distance lies in a difference cover are ranked first,
from the right end on, and every suffix is then sorted by the few bytes up to its
next cover position and that position's rank, which settles ties of any length.
Neighbours in that order are compared over 200 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_materialized, materialize, ship_package, text_key, text_or_empty

LENGTH = 200
GRAM = 50  # bytes of an anchor
COVER = 4  # the cover is taken modulo COVER**2
#: Contexts of one bucket that are sorted together; a bucket with more is split
#: by the bytes that all suffixes of one half of it share.
BLOCK = 32_768

_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def difference_cover(root: int = COVER) -> list[int]:
    """Residues modulo ``root**2`` whose differences are all residues: the first
    ``root`` of them and every ``root``-th."""
    return sorted({*range(root), *range(0, root * root, root)})


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """Minimum or maximum (``op``) of every ``width`` neighbours."""
    n = len(x)
    pad = -n % width
    fill = np.iinfo(x.dtype).max if op is np.minimum else 0
    rows = np.concatenate([x, np.full(pad, fill, x.dtype)]).reshape(-1, width)
    ahead = op.accumulate(rows, axis=1).ravel()
    behind = op.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[:n - width + 1], ahead[width - 1:n])


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-grams that are smallest in some ``length`` bytes.

    The hash of a k-gram depends on its bytes alone, and ties all count, so equal
    strings have equal anchors at equal distances."""
    n, width = len(raw), length - gram + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
    # hash of g bytes, doubled: H(2g) = H(g) * B**g + H(g further on)
    total, done, size, power, h, left = np.zeros(n - gram + 1, np.uint64), 0, 1, _BASE, x, gram
    while left:
        if left & 1:
            total = total * power + h[done:done + len(total)]
            done += size
        left >>= 1
        if left:
            h = h[:-size] * power + h[size:]
            power, size = np.uint64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF), size * 2
    total = (total ^ (total >> np.uint64(31))) * _MIX
    total ^= total >> np.uint64(29)
    low = _slide(total, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    reach = _slide(np.concatenate([edge, low, edge]), width, np.maximum)
    at = np.nonzero(reach == total)[0]
    return at, total[at].view(np.int64)


def context(raw: bytes, at: int, first: int, last: int, length: int = LENGTH) -> tuple[int, int, bytes]:
    """``(o1, o2, bytes)``: the windows that start o bytes before ``at``, for o in
    [o1, o2] (the part of [first, last] that lies in the text), as one string."""
    o1, o2 = max(first, at + length - len(raw)), min(last, at)
    return o1, o2, raw[at - o2:at - o1 + length]


def repeated_offsets(o1: np.ndarray, o2: np.ndarray, texts: list[bytes], copies: np.ndarray,
                     length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Matrix (context, o): True if the window o bytes before the context's anchor
    occurs again, in another context or because the context has copies."""
    width, m = length - gram + 1, len(texts)
    x = np.zeros((m, width - 1 + length), np.uint8)
    for i, (b, o, t) in enumerate(zip(o2, o1, texts)):
        x[i, width - 1 - b:width - 1 - o + length] = np.frombuffer(t, np.uint8)
    flags = np.zeros((m, width), bool)
    mod, cover = COVER * COVER, set(difference_cover())
    rank, order = np.zeros(m, np.int64), np.arange(m)  # of the nearest cover place to the right
    place = x.shape[1]
    for c in range(x.shape[1] - 1, -1, -1):
        key = rank.copy()  # the bytes up to the next cover place, then its rank
        for j in range(c, place):
            key |= x[:, j].astype(np.int64) << (24 + 8 * (place - 1 - j))
        o = width - 1 - c
        if c % mod in cover:
            order = np.argsort(key, kind="stable")
            step = np.ones(m, np.int64)
            step[1:] = key[order][1:] != key[order][:-1]
            fresh = np.empty(m, np.int64)
            fresh[order] = np.cumsum(step) - 1
        if 0 <= o < width:
            inside = (o1 <= o) & (o <= o2)
            s = order if c % mod in cover else np.argsort(key, kind="stable")
            s = s[inside[s]]
            a, b = s[:-1], s[1:]
            alike = np.nonzero((x[a, c] == x[b, c]) & (x[a, c + length - 1] == x[b, c + length - 1]))[0]
            a, b = a[alike], b[alike]
            same = (x[a, c:c + length] == x[b, c:c + length]).all(axis=1)
            flags[a[same], o] = True
            flags[b[same], o] = True
            flags[inside & (copies > 1), o] = True
        if c % mod in cover:
            rank, place = fresh, c
    return flags


def covered(flags: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Byte ranges, relative to the anchor, that the flagged windows cover."""
    out: list[tuple[int, int]] = []
    for o in np.nonzero(flags)[0][::-1].tolist():
        if out and -o <= out[-1][1]:
            out[-1] = (out[-1][0], length - o)
        else:
            out.append((-o, length - o))
    return out


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [anchors(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column(1)]
        whose = np.repeat(np.arange(len(found)), [len(at) for at, _ in found])
        for a in range(0, len(whose), 100_000):
            some = slice(a, a + 100_000)
            nodes = batch.column(0).take(pa.array(whose[some]))
            at, h = (np.concatenate([f[k] for f in found])[some] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(h), nodes, pa.array(at)], ["h", "node", "at"])


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [z.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["id", "z"])


_CONTEXT = "node binary, at long, key binary, o1 int, o2 int, ctx binary, rows long"


def _context_id() -> Column:
    return F.unhex(F.md5(F.concat("key", F.encode(F.concat_ws(",", "o1", "o2", F.lit("")), "utf-8"), "ctx")))


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z, cols = zstandard.ZstdDecompressor(), []
    for batch in batches:
        for node, packed, places, rows in zip(*(batch.column(i) for i in range(4))):
            raw, node, rows = z.decompress(packed.as_py()), node.as_py(), rows.as_py()
            for p in places.as_py():
                o1, o2, ctx = context(raw, p["at"], 0, LENGTH - GRAM)
                cols.append((node, p["at"], p["h"].to_bytes(8, "big", signed=True), o1, o2, ctx, rows))
                if len(cols) >= 5000:
                    yield _rows(cols)
                    cols = []
    yield _rows(cols)


def _rows(cols: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
    names = ["node", "at", "key", "o1", "o2", "ctx", "rows"]
    parts = list(zip(*cols)) if cols else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(parts, kinds)], names)


def _halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of an oversized bucket as two rows, each with half of the offsets;
    the new key adds the bytes that all windows of the half share."""
    for batch in batches:
        cols = []
        for cid, key, o1, o2, first, last, ctx in zip(*(batch.column(i).to_pylist() for i in range(7))):
            mid = (first + last) // 2
            for f, t in ((first, mid), (mid + 1, last)):
                a, b = max(f, o1), min(t, o2)
                if a > b:
                    continue
                part = ctx[o2 - b:o2 - a + LENGTH]  # the windows a..b
                core = part[b - f:b - t + LENGTH]  # what all windows f..t share
                cols.append((cid, hashlib.md5(key + bytes([f, t]) + core).digest(), a, b, f, t, part))
        kinds = [pa.binary(), pa.binary(), *[pa.int32()] * 4, pa.binary()]
        parts = list(zip(*cols)) if cols else [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(parts, kinds)],
                                         ["cid", "key", "o1", "o2", "first", "last", "ctx"])


def _sort_blocks(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows of whole buckets, then of the one being read
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held and held[-1][1] != row[1]:
                    if len(held) >= block:
                        yield _solve(held)
                        held = []
                held.append(row)
        yield _solve(held)

    return run


def _solve(held: list[tuple]) -> pa.RecordBatch:
    cids, lows, highs = [], [], []
    if held:
        cid, _, o1, o2, ctx, n = zip(*held)
        flags = repeated_offsets(np.array(o1), np.array(o2), list(ctx), np.array(n))
        for i in np.nonzero(flags.any(axis=1))[0]:
            for a, b in covered(flags[i]):
                cids.append(cid[i])
                lows.append(a)
                highs.append(b)
    return pa.RecordBatch.from_arrays([pa.array(cids, pa.binary()), pa.array(lows, pa.int32()), pa.array(highs, pa.int32())],
                                      ["cid", "low", "high"])


def repeated_ranges(docs: DataFrame, text: str = "text", block: int = BLOCK) -> DataFrame:
    """``(node, spans)``: by text key, the byte ranges ``{low, high}`` (they may
    overlap) that repeated 200-byte strings cover. Texts without any are absent."""
    ship_package(docs.sparkSession)
    d = docs.select(text_key(text).alias("node"), text_or_empty(text).alias("t"))
    found = materialize(d.mapInArrow(_find_anchors, "h long, node binary, at long"), "anchors")
    # written, so that both sides of the join are plain shuffles and a hot hash can be split
    repeated = materialize(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "repeated")
    places = found.join(repeated, "h").groupBy("node").agg(F.collect_set(F.struct("at", "h")).alias("places"))
    texts = d.mapInArrow(_squeeze, "id binary, z binary").groupBy("id").agg(F.first("z").alias("z"), F.count(F.lit(1)).alias("rows"))
    cut = places.join(texts, places["node"] == texts["id"]).select("node", "z", "places", "rows")
    # a text of several rows repeats everything in it; its contexts count for each row
    contexts = materialize(cut.mapInArrow(_cut_contexts, _CONTEXT).withColumn("cid", _context_id()), "contexts")
    drop_materialized(found)
    drop_materialized(repeated)
    at = materialize(contexts.select("node", "at", "cid"), "places")
    counted = contexts.groupBy("cid", "key", "o1", "o2", "ctx").agg(F.sum("rows").alias("n"))
    todo = counted.withColumns({"first": F.lit(0), "last": F.lit(LENGTH - GRAM)})
    root, used = None, []  # split contexts: (cid, parent); bucket tables until they are sorted
    out = None
    while True:
        todo = materialize(todo.select("cid", "key", "o1", "o2", "first", "last", "ctx", "n"), "buckets")
        used.append(todo)
        if contexts is not None:  # the distinct ones are in the bucket table
            drop_materialized(contexts)
            contexts = None
        sizes = todo.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        large = materialize(sizes.where(F.col("size") > block).select("key"), "large")
        whole = todo.join(large, "key", "left_anti")
        # a bucket with a single context without copies holds no repeat
        alone = sizes.where("size = 1").select("key")
        lonely = F.col("n") == 1
        sort_in = whole.join(alone.withColumn("one", F.lit(True)), "key", "left").where(~(lonely & F.col("one").isNotNull()))
        ready = sort_in.select("cid", "key", "o1", "o2", "ctx", "n").repartition("key").sortWithinPartitions("key")
        hits = ready.mapInArrow(_sort_blocks(block), "cid binary, low int, high int")
        if root is not None:
            hits = hits.join(root, "cid").select(F.col("parent").alias("cid"), "low", "high")
        out = hits if out is None else out.unionByName(hits)
        if large.isEmpty():
            break
        split = todo.join(large, "key", "left_semi")
        halves = materialize(split.select("cid", "key", "o1", "o2", "first", "last", "ctx").mapInArrow(
            _halve, "cid binary, key binary, o1 int, o2 int, first int, last int, ctx binary"), "halves")
        halves = halves.withColumnRenamed("cid", "old").withColumn("cid", _context_id())
        step = halves.select("old", "cid").distinct()
        numbers = split.select(F.col("cid").alias("old"), "n")
        todo = halves.join(numbers, "old").groupBy("cid", "key", "o1", "o2", "first", "last", "ctx").agg(F.sum("n").alias("n"))
        up = step if root is None else step.join(root.withColumnRenamed("cid", "old"), "old").select("parent", "cid")
        root = materialize(up.select("cid", F.col("old").alias("parent")) if root is None else up.select("cid", "parent").distinct(), "roots")
    hits = materialize(out.distinct(), "hits")
    for table in used:
        drop_materialized(table)
    spans = at.join(hits, "cid").select("node", F.struct((F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high")).alias("high")).alias("s"))
    return spans.groupBy("node").agg(F.collect_set("s").alias("spans"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK,
                   keep_text: bool = False) -> DataFrame:
    """Per document row: bytes, bytes removed, maximal runs removed, SHA-256 of
    the rest; ``keep_text`` adds the rest itself (binary) and the runs.

    Texts are judged as they come in, as UTF-8, and matches never cross
    documents. Rows of equal texts are repeats of one another. NULL is empty;
    texts under 200 bytes lose nothing."""
    spans = repeated_ranges(docs, text, block)
    keyed = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_key(text).alias("id"), text_or_empty(text).alias("t"))
    packed = keyed.select(F.struct("doc_id", "id").alias("r"), "t").mapInArrow(_squeeze, "id struct<doc_id: long, id: binary>, z binary")
    joined = packed.select("id.doc_id", F.col("id.id").alias("node"), "z").join(spans, "node", "left").select("doc_id", "z", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if keep_text:
        schema += ", kept binary, spans array<struct<low: long, high: long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for i, packed_text, found in zip(*(batch.column(c) for c in range(3))):
                raw = z.decompress(packed_text.as_py())
                runs: list[list[int]] = []
                for s in sorted((s["low"], s["high"]) for s in found.as_py() or ()):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append(list(s))
                ends = [0, *[e for r in runs for e in r], len(raw)]
                kept = b"".join([raw[a:b] for a, b in zip(ends[::2], ends[1::2])])
                row = (i.as_py(), len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept, [{"low": a, "high": b} for a, b in runs]) if keep_text else row)
            span = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            kinds = [pa.int64()] * 4 + [pa.string()] + ([pa.binary(), span] if keep_text else [])
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"][:len(kinds)]
            cols = list(zip(*rows)) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return joined.mapInArrow(run, schema)
