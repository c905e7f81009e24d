"""Benchmark decontamination by pigeonhole edit matching (op 6).

An item of n characters may differ from a passage of a document by at most
``e = floor(error_rate * n)`` character edits. It is split into ``e + 1``
pieces; e edits can't touch them all, so every match holds a piece unchanged.
One Aho-Corasick pass over a document finds all piece hits, and Myers'
bit-parallel distance decides each place that a hit names. An item too short for a single
edit matches unchanged and between word borders.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package, text_or_empty

ERROR_RATE = 0.06
#: Characters of benchmark text in one automaton; a larger benchmark is matched
#: in that many passes, each with its own block of items.
BLOCK_CHARS = 2_000_000

MATCH_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()),
    T.StructField("distance", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("passage", T.StringType()),
])


def normalise(text: str | None) -> str:
    """Lower case with every run of white space as one blank."""
    return " ".join((text or "").lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` consecutive pieces of nearly equal length: (offset, piece)."""
    k, n = errors + 1, len(item)
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, limit: int, anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of the whole ``pattern`` to a substring of ``text``,
    and the end of the leftmost substring that has it; ``(limit + 1, -1)`` if
    the distance is over ``limit``. ``anchored``: the substring starts at 0.

    Myers' bit-vector recurrence; Python's integers carry any pattern length."""
    m = len(pattern)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    at: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        at[c] |= 1 << i
    up, down, score = mask, 0, m
    best, end = (m, 0) if m <= limit else (limit + 1, -1)
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        cross = (((eq & up) + up) ^ up) | eq
        vertical = eq | down
        plus = down | (~(cross | up) & mask)
        minus = up & cross
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = ((plus << 1) | anchored) & mask
        minus = (minus << 1) & mask
        up = minus | (~(vertical | plus) & mask)
        down = plus & vertical
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """All matches of one block of items in one text."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        import ahocorasick

        self.items = [(i, t, int(error_rate * len(t))) for i, t in items]
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, t, e) in enumerate(self.items):
            for offset, piece in pieces(t, e):
                where[piece].append((k, offset + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in where.items():
            self.automaton.add_word(piece, uses)
        if where:
            self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """For each item with a hit, the merged windows that can hold a match."""
        found: dict[int, set[int]] = defaultdict(set)
        for last, uses in self.automaton.iter(text) if self.items else ():
            for k, piece_end in uses:
                found[k].add(last + 1 - piece_end)  # where the item would start without indels
        merged: dict[int, list[tuple[int, int]]] = {}
        for k, starts in found.items():
            _, t, e = self.items[k]
            spans: list[tuple[int, int]] = []
            for s in sorted(starts):
                a, b = max(0, s - e), min(len(text), s + len(t) + e)
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
                else:
                    spans.append((a, b))
            merged[k] = spans
        return merged

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of the best match of every matching item."""
        for k, spans in self.windows(text).items():
            item_id, t, e = self.items[k]
            if not e:
                at = _whole(t, text)
                if at >= 0:
                    yield item_id, 0, at, at + len(t)
                continue
            best = None
            for a, b in spans:
                d, end = myers(t, text[a:b], e)
                if d <= e and (best is None or d < best[0]):
                    back = text[max(0, a + end - len(t) - e):a + end][::-1]
                    _, length = myers(t[::-1], back, d, anchored=True)
                    best = (d, a + end - length, a + end)
            if best:
                yield item_id, *best

    def any(self, text: str) -> bool:
        return next(self.matches(text), None) is not None


def _whole(item: str, text: str) -> int:
    """Where ``item`` first stands in the text without cutting a word, or -1."""
    at = text.find(item)
    while at >= 0:
        end = at + len(item)
        if not (at and text[at - 1].isalnum() and item[0].isalnum()) and not (
                end < len(text) and text[end].isalnum() and item[-1].isalnum()):
            return at
        at = text.find(item, at + 1)
    return -1


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_chars`` characters, one at a time.

    Items that are NULL or blank are left out; those without an id stay."""
    b = benchmark.select(F.col(item_id).cast("bigint").alias("i"), F.col(text).alias("t")).dropna(subset=["t"]).distinct()
    total = b.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-total // block_chars)
    for k in range(n):
        rows = b.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).orderBy("i", "t").collect()
        items = [(r["i"], normalise(r["t"])) for r in rows]
        yield [x for x in items if x[1]]


def find_matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE,
                 doc_id: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per (document row, item) that match: distance, and start, end
    and text of the passage in the normalised document (lower case, white-space
    runs as one blank). The leftmost passage of least distance is reported.

    Whole texts are searched in one pass for each block of items, without a
    shuffle. NULL and empty texts have no match; repeated document rows each
    have theirs; an empty benchmark gives no rows."""
    ship_package(docs.sparkSession)
    d = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("t"))
    out = d.sparkSession.createDataFrame([], MATCH_SCHEMA)
    for items in item_blocks(benchmark, block_chars=block_chars):
        out = out.unionByName(d.mapInArrow(_search(items, error_rate), MATCH_SCHEMA))
    return out


def _search(items: list[tuple[int, str]], error_rate: float):
    names = MATCH_SCHEMA.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, error_rate)
        for batch in batches:
            rows = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = normalise(t.as_py())
                rows += [(i, *m, whole[m[2]:m[3]]) for m in matcher.matches(whole)]
            cols = list(zip(*rows)) if rows else [[] for _ in names]
            kinds = [pa.int64()] * 5 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE,
                      text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no item."""
    ship_package(docs.sparkSession)
    out = docs
    for items in item_blocks(benchmark, block_chars=block_chars):
        held = _holds(items, error_rate)(text_or_empty(out[text]))
        both = out.select(F.struct(*[out[c] for c in out.columns]).alias("row"), held.alias("held"))
        out = both.where(~F.col("held")).select("row.*")
    return out


def _holds(items: list[tuple[int, str]], error_rate: float):
    @F.pandas_udf(T.BooleanType())
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(items, error_rate)
        for texts in batches:
            yield texts.map(lambda t: matcher.any(normalise(t))).astype(bool)

    return holds
