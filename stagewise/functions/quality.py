"""Data-quality counts for lenient parsing (trap T3: count, don't fail)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .parse import typed


def reject_counts(raw: DataFrame, spec: Mapping[str, tuple[str, str]], malformed: str | None = None) -> DataFrame:
    """One row: for each typed column of ``spec`` (``{src: (dst, type)}``),
    ``rejected_<dst>`` = rows whose text is present but does not parse,
    plus ``rows``; with ``malformed`` (a column that is NULL in well-formed
    rows) also ``rejected_(line)``. One aggregate pass with map-side partial
    counts."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for src, (dst, to) in spec.items():
        if to == "string":
            continue
        bad = F.col(src).isNotNull() & typed(raw, src, to).isNull()
        aggs.append(F.count(F.when(bad, 1)).alias(f"rejected_{dst}"))
    if malformed is not None:
        aggs.append(F.count(malformed).alias("rejected_(line)"))
    return raw.agg(*aggs)
