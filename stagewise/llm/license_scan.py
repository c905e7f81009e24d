"""License scans by patience alignment (op 1).

Words that occur once in the text and once in the template anchor the alignment;
the longest increasing subsequence of anchors is kept and each gap between two
anchors is aligned in the same way. Coverage is the share of the template's words
that the alignment reaches.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_package, text_or_empty

COVERAGE = 0.8
#: Usual wordings of license notices.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation",
    "mit-notice": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files, to deal in the Software without restriction",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                 "the following conditions are met",
}
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("license", T.StringType()),
    T.StructField("coverage", T.DoubleType()), T.StructField("start_word", T.LongType()),
    T.StructField("end_word", T.LongType()),
])
_WORD = re.compile(r"[\w.+-]*\w")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places (i in a, j in b) of equal words, increasing in both.

    Equal ends are taken as they are, then the words unique to both sides; a gap
    without any is left unaligned but for its equal ends."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i2, j, j2 = todo.pop()
        while i < i2 and j < j2 and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i2 and j < j2 and a[i2 - 1] == b[j2 - 1]:
            i2, j2 = i2 - 1, j2 - 1
            out.append((i2, j2))
        if i >= i2 or j >= j2:
            continue
        in_a, in_b = Counter(a[i:i2]), Counter(b[j:j2])
        at = {w: y for y, w in enumerate(b[j:j2], j) if in_b[w] == 1}
        anchors = [(x, at[w]) for x, w in enumerate(a[i:i2], i) if in_a[w] == 1 and w in at]
        chain = increasing(anchors)
        if not chain:
            continue
        out += chain
        edges = [(i - 1, j - 1), *chain, (i2, j2)]
        todo += [(x + 1, x2, y + 1, y2) for (x, y), (x2, y2) in zip(edges, edges[1:])]
    return sorted(out)


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence whose second parts increase (pairs come by first part)."""
    tops: list[int] = []  # smallest last value of a chain of each length
    ends: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, y) in enumerate(pairs):
        p = bisect_left(tops, y)
        back[k] = ends[p - 1] if p else -1
        tops[p:p + 1], ends[p:p + 1] = [y], [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def stretches(text: list[str], template: list[str], least: float) -> list[tuple[int, int]]:
    """Stretches ``(first, end)`` of the text that hold enough of the template's
    words, counted, to reach ``least``.

    They begin at words of the template, wherever these stand: windows as long
    and twice as long as the template from each such word on, and whole runs of
    them with no gap longer than the template."""
    size, want = len(template), Counter(template)
    hits = [k for k, w in enumerate(text) if w in want]
    out = []
    for width in (size, 2 * size):
        held, total, right = Counter(), 0, 0
        for k in hits:
            while right < len(hits) and hits[right] < k + width:
                w = text[hits[right]]
                held[w] += 1
                total += held[w] <= want[w]
                right += 1
            if total >= least * size:
                out.append((k, min(k + width, len(text))))
            total -= held[text[k]] <= want[text[k]]
            held[text[k]] -= 1
    runs = [i for i in range(len(hits)) if not i or hits[i] - hits[i - 1] > size]
    for i, j in zip(runs, [*runs[1:], len(hits)]):
        if (want & Counter(text[k] for k in hits[i:j])).total() >= least * size:
            out.append((hits[i], hits[j - 1] + 1))
    return sorted(set(out))


def covers(text: list[str], template: list[str], least: float) -> list[tuple[float, int, int]]:
    """``(coverage, first word, end word)`` of the passages of the text that cover the template to ``least`` or
    more, in the order of the text. Of overlapping ones that of best coverage counts (of equals the
    shortest, then the leftmost), so a notice that stands twice in a text is two passages.

    Stretches are placed by the text's own words (see ``stretches``), so where a
    passage stands doesn't matter. A passage up to twice as long as the template
    lies whole in one; a longer one does if no gap between two of its template
    words is longer than the template. Each is widened by a template's length
    past its last aligned word for as long as that aligns more words."""
    size, hits = len(template), set()
    for a, b in stretches(text, template, least):
        found = patience(text[a:b], template)
        while found and len(found) < size:
            more = patience(text[a:a + found[-1][0] + 1 + size], template)
            if len(more) <= len(found):
                break
            found = more
        share = len(found) / size
        if found and share >= least:
            hits.add((share, a + found[0][0], a + found[-1][0] + 1))
    starts: list[int] = []  # of the passages taken, which don't overlap
    taken: list[tuple[float, int, int]] = []
    for hit in sorted(hits, key=lambda h: (-h[0], h[2] - h[1], h[1])):
        k = bisect_left(starts, hit[1])
        if (not k or taken[k - 1][2] <= hit[1]) and (k == len(starts) or hit[2] <= starts[k]):
            starts.insert(k, hit[1])
            taken.insert(k, hit)
    return taken


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = COVERAGE,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per (document row, license, passage) with coverage >= ``least``: coverage
    and the covered stretch, in words. Whole texts, one pass, no shuffle.

    Of licenses whose passages overlap only those of best coverage are named.
    NULL and empty texts have no row; repeated rows each have theirs. Templates
    without words are ignored."""
    ship_package(docs.sparkSession)
    split = {name: words(t) for name, t in sorted((templates or TEMPLATES).items())}
    split = {name: w for name, w in split.items() if w}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                low, mine, hits = t.as_py().lower(), None, []
                for name, template in split.items():
                    if not _may_hold(low, template, least):
                        continue
                    mine = words(low) if mine is None else mine
                    hits += [(name, *hit) for hit in covers(mine, template, least)]
                rows += [(i, *h) for h in _best(hits)]
            cols = list(zip(*rows)) if rows else [[] for _ in SCHEMA.names]
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], SCHEMA.names)

    d = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("t"))
    return d.mapInArrow(run, SCHEMA)


def _best(hits: list[tuple]) -> list[tuple]:
    """The passages that no overlapping one of another license covers better."""
    out, near = [], []
    order = sorted(range(len(hits)), key=lambda k: hits[k][2])
    for n, k in enumerate(order):
        h = hits[k]
        near = [x for x in near if x[3] > h[2]]  # those before it that reach it; after it come those that start in it
        after = []
        for m in order[n + 1:]:
            if hits[m][2] >= h[3]:
                break
            after.append(hits[m])
        if not any(o[1] > h[1] for o in near + after):
            out.append(k)
        near.append(h)
    return [hits[k] for k in sorted(out)]


def _may_hold(low: str, template: list[str], least: float) -> bool:
    """False if so many template words are nowhere in the text that no alignment suffices."""
    spare = len(template) * (1 - least) + 1e-9
    for w in sorted(template, key=len, reverse=True):
        if w not in low:
            spare -= 1
            if spare < 0:
                return False
    return True
