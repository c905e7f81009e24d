"""Best-two-fit packing of tokenised documents into fixed-length sequences (op 4).

Documents are tokenised once on the executors. The packing itself needs only how
many pieces there are of each length, at most ``capacity`` numbers, so every piece
of the whole table takes part in one packing: bins of the same content are planned
together, and pieces are then dealt to the planned places by their rank within
their length.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LONG_BLANKS, materialize, ship_package, text_or_empty

CAPACITY = 1024
END_ID = 2
#: Pieces of one length are ranked in parts of about this many, each in a task of its own.
PART_ROWS = 200_000

PIECE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])
#: Fixed value: how a byte-level BPE of this kind cuts a text into words.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class _Ids:
    """Ids of a text as little-endian unsigned 32-bit bytes.

    tiktoken with the tokenizer file's own vocabulary gives the ids of ``tokenizers`` in
    a fraction of the time and memory; that needs a vocabulary in merge order. Any
    other file, a text that may name a special token, and very long runs of blanks (which
    tiktoken's pattern walks back over on its stack) go to ``tokenizers``."""

    def __init__(self, path: str):
        self.path, self.tokenizer = path, None
        self.quick = _merge_order_encoding(path)

    def whole(self, text: str) -> bytes:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.quick is None or "<|" in text or LONG_BLANKS.search(text):
            return self.whole(text)
        return np.array(self.quick.encode_ordinary(text), "<u4").tobytes()


def _merge_order_encoding(path: str):
    """A tiktoken encoding of a byte-level BPE file whose ids follow its merges, else None."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model.get("merges", [])]
    vocab = model.get("vocab", {})
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    in_order = all(vocab.get(m) == 256 + i for i, m in enumerate(merges))
    if model.get("type") != "BPE" or spec.get("normalizer") or not plain or not merges or not in_order:
        return None
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in kept]
    byte = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(shifted)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte[c] for c in w): i for w, i in vocab.items() if w not in special}
    return tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


_TABLES: dict[str, _Ids] = {}


def tokenise_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id",
                    text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document: its ids, then END_ID.

    A longer document is cut into full pieces; the first one takes the rest and
    may be shorter. A NULL or empty text is the single id END_ID. ``keep_ids``
    adds the ids themselves (``array<int>``). ``tokenizer`` is the path of the
    vocabulary file on every executor."""
    ship_package(docs.sparkSession)
    schema = T.StructType(PIECE_SCHEMA.fields + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else []))
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _TABLES.get(tokenizer)
        if table is None:
            table = _TABLES[tokenizer] = _Ids(tokenizer)
        for batch in batches:
            rows = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = table.encode(t.as_py()) + end
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[4 * a:4 * b]
                    row = (i, k, a, b - a, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4").astype(np.int32)) if keep_ids else row)
            cols = list(zip(*rows)) if rows else [[] for _ in schema.names]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], schema.names)

    d = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("t"))
    return d.mapInArrow(run, schema)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Best-two-fit over counts of lengths: ``(number of equal bins, lengths in them)``.

    A bin is filled greedily with the longest length that still fits; then its
    smallest piece is replaced by two unpacked ones that fill the gap which its
    removal leaves more tightly, while that helps. The same content is repeated
    as often as the counts allow, so the number of steps depends on the number
    of different lengths, not of pieces."""
    left = {n: c for n, c in counts.items() if c > 0}
    plan = []
    while left:
        lengths = sorted(left, reverse=True)
        used: Counter[int] = Counter()
        bin_, gap = [], capacity
        for n in lengths:
            k = min(gap // n, left[n])
            if k:
                bin_ += [n] * k
                used[n] += k
                gap -= n * k
        while gap and bin_:
            small = bin_[-1]
            free = {n for n in lengths if left[n] > used[n]}
            pair = _two_for(gap + small, small, free, lambda n: left[n] - used[n])
            if not pair:
                break
            bin_.pop()
            used[small] -= 1
            bin_ = sorted(bin_ + list(pair), reverse=True)
            used.update(pair)
            gap += small - sum(pair)
        times = min(left[n] // k for n, k in used.items() if k)
        plan.append((times, bin_))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return plan


def _two_for(room: int, small: int, free: set[int], spare) -> tuple[int, int] | None:
    """The two lengths of ``free`` with the largest sum in ``(small, room]``."""
    for total in range(room, small, -1):
        for a in range(total // 2, 0, -1):
            b = total - a
            if a in free and b in free and (a != b or spare(a) > 1):
                return b, a
    return None


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; lengths are 1 to ``capacity``.

    The driver holds ``capacity`` counts, the plan made of them (fewer
    rows than the sum of bin sizes of its distinct bins, so bounded by the
    capacity too), and a count for every ``PART_ROWS`` pieces of a length. Equal rows are
    interchangeable, so a task that runs again deals the same rows out. ``pieces`` is read
    three times: write it first."""
    spark = pieces.sparkSession
    sizes = pieces.groupBy("length").agg(F.ceil(F.count(F.lit(1)) / F.lit(PART_ROWS)).alias("__parts"))
    sizes = spark.createDataFrame(sizes.collect(), "length long, __parts long")  # `capacity` rows at most
    p = pieces.join(F.broadcast(sizes), "length").withColumn("__part", F.pmod(F.xxhash64("doc_id", "piece"), F.col("__parts")))
    per_part = p.groupBy("length", "__part").agg(F.count(F.lit(1)).alias("n")).collect()
    counts: Counter[int] = Counter()
    before = []
    for r in sorted(per_part, key=lambda r: (r["length"], r["__part"])):
        before.append((r["length"], r["__part"], counts[r["length"]]))
        counts[r["length"]] += r["n"]
    places, dealt, bins = [], Counter(), 0
    for times, bin_ in plan_bins(counts, capacity):
        offset = 0
        for n in bin_:
            places.append((n, dealt[n], dealt[n] + times, bins, offset))
            dealt[n] += times
            offset += n
        bins += times
    from pyspark.sql import Window

    base = spark.createDataFrame(before, "length long, __part long, __before long")
    place = spark.createDataFrame(places, "length long, __from long, __to long, __bin long, __offset long")
    rank = F.row_number().over(Window.partitionBy("length", "__part").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = p.join(F.broadcast(base), ["length", "__part"]).withColumn("__rank", rank - 1 + F.col("__before"))
    spots = place.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("__from", "__to", "__bin", "__offset"))).alias("__spots"))
    spot = F.filter("__spots", lambda s: (s["__from"] <= F.col("__rank")) & (F.col("__rank") < s["__to"]))[0]
    return (
        ranked.join(F.broadcast(spots), "length").withColumn("__spot", spot)
        .select(*[F.col(c) for c in pieces.columns],
                (F.col("__spot.__bin") + F.col("__rank") - F.col("__spot.__from")).alias("sequence_id"),
                F.col("__spot.__offset").alias("offset"))
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id",
                   text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Every document's pieces with their sequence and place in it."""
    return pack(materialize(tokenise_pieces(docs, tokenizer, capacity, doc_id, text, keep_ids), "pieces"), capacity)
