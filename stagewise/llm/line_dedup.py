"""Line dedup by site-relative frequency (op 9).

For every host, the share of its pages that hold a line; lines on more than
``ratio`` of the host's pages are boilerplate and are dropped from that host's
pages. A line on fewer than ``min_pages`` pages (two: it occurs again) is none,
or a host of few pages would lose all it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

RATIO = 0.05
MIN_PAGES = 2


def _key(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text",
                ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, lines)``: the 64-bit keys of each host's boilerplate lines.

    A page counts once for a line it repeats. Pages of a NULL host form one
    host; a NULL or empty text is a page without lines; blank lines are never
    counted. Counting groups on (host, line key) with map-side combine, so one
    host with a third of all pages is no hot group. A host's array holds at
    most (mean lines per page) / ratio keys, whatever its number of pages."""
    d = docs.select(F.col(host).alias("h"), text_or_empty(text).alias("t"))
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col("t")), lambda x: _key(x) != ""),
                                        lambda x: F.xxhash64(_key(x))))
    counts = d.select("h", F.explode(keys).alias("k")).groupBy("h", "k").agg(F.count(F.lit(1)).alias("n"))
    totals = d.groupBy("h").agg(F.count(F.lit(1)).alias("pages")).withColumnRenamed("h", "h2")
    return (
        counts.where(F.col("n") >= min_pages)
        .join(totals, F.col("h").eqNullSafe(F.col("h2")))
        .where(F.col("n") > F.col("pages") * F.lit(float(ratio)))
        .groupBy("h").agg(F.sort_array(F.collect_list("k")).alias("lines"))
    )


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text",
                     ratio: float = RATIO, min_pages: int = MIN_PAGES,
                     dropped: str | None = None) -> DataFrame:
    """``docs`` with its hosts' boilerplate lines removed from ``text``.

    Same rows and columns (other columns pass through whatever their names);
    ``dropped`` names an extra column with the number of lines removed. Blank
    lines and the order of lines stay. A NULL text stays NULL. Repeated rows
    are separate pages. The boilerplate table is written first, so the planner
    knows its real size when it chooses between a broadcast and a shuffle join."""
    b = materialize(boilerplate(docs, host, text, ratio, min_pages), "boilerplate")
    b = b.select(F.col("h").alias("__llm_h"), F.col("lines").alias("__llm_lines"))
    j = docs.join(b, docs[host].eqNullSafe(b["__llm_h"]), "left")
    t = docs[text]
    kept = F.filter(_lines(t), lambda x: (_key(x) == "") | ~F.array_contains(b["__llm_lines"], F.xxhash64(_key(x))))
    clean = F.when(b["__llm_lines"].isNull() | t.isNull(), t).otherwise(F.array_join(kept, "\n"))
    cols = [clean.alias(c) if c == text else docs[c] for c in docs.columns]
    if dropped:
        n = F.when(b["__llm_lines"].isNull() | t.isNull(), F.lit(0)).otherwise(F.size(_lines(t)) - F.size(kept))
        cols.append(n.cast("bigint").alias(dropped))
    return j.select(*cols)


def recount(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``n_chars`` set to the length of ``text`` in code points where the table has it."""
    if n_chars not in docs.columns:
        return docs
    kind = docs.schema[n_chars].dataType
    return docs.select(*[F.length(docs[text]).cast(kind).alias(c) if c == n_chars else docs[c] for c in docs.columns])
