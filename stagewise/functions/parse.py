"""Lenient typed parsing of landing strings (rename + cast, P1-P3).

Landing files are read as text. A bad value must not stop a scheduled
load (under ANSI casts it would raise ``CAST_INVALID_INPUT``), so every
parse here is a ``try_*`` form that yields NULL; callers count the NULLs
as rejects (see ``functions.quality.reject_counts``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd")
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text -> DATE, trying ISO first and then each pattern; NULL if none fits."""
    c = _col(c)
    attempts = [c.try_cast("date")] + [F.try_to_date(c, f) for f in formats]
    return F.coalesce(*attempts)


def parse_timestamp(c: str | Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Text -> TIMESTAMP, trying the default cast and then each pattern."""
    c = _col(c)
    attempts = [c.try_cast("timestamp")] + [F.try_to_timestamp(c, F.lit(f)) for f in formats]
    return F.coalesce(*attempts)


def parse_int(c: str | Column) -> Column:
    """Text -> INT; decimal text (``35.0``) is truncated, other text is NULL."""
    return _col(c).try_cast("decimal(20,4)").try_cast("int")


def typed(df: DataFrame, name: str, to: str) -> Column:
    """Cast column ``name`` of ``df`` to ``to`` leniently.

    Columns that already carry the target (or a compatible temporal) type
    are cast plainly, so conforming an already typed table is a no-op.
    """
    c = F.col(name)
    current = df.schema[name].dataType
    if to == "date":
        if isinstance(current, (DateType, TimestampType, TimestampNTZType)):
            return c.cast("date")
        return parse_date(c)
    if to == "timestamp":
        if isinstance(current, (DateType, TimestampType, TimestampNTZType)):
            return c.cast("timestamp")
        return parse_timestamp(c)
    if to == "string":
        return c.cast("string")
    if to == "int" and isinstance(current, StringType):
        return parse_int(c)
    return c.try_cast(to)


def conform(df: DataFrame, spec: Mapping[str, tuple[str, str]], keep_rest: bool = False) -> DataFrame:
    """Rename and cast in one projection: ``spec = {src: (dst, type)}``.

    Columns absent from ``spec`` are dropped unless ``keep_rest``.
    """
    cols = [typed(df, src, to).alias(dst) for src, (dst, to) in spec.items()]
    if keep_rest:
        cols += [F.col(c) for c in df.columns if c not in spec]
    return df.select(*cols)
