"""Column-expression builders: flags, value maps, buckets, change tests.

All of these return plain ``Column`` expressions, so they stay inside
whole-stage codegen and compose with any projection or aggregate.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (
    AGE_BUCKETS,
    AGE_OTHER,
    CLIENT_ID_LENGTH,
    QUALITY_FAILED,
    QUALITY_PASSED,
    VALID_COMPLETE_PROCESS,
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_expr(v: str | Column) -> Column:
    """MERGE value/condition: a ``Column`` as is, a string as SQL text.

    ``'Null'`` (any case) is SQL NULL, as in a MERGE clause.
    """
    if isinstance(v, Column):
        return v
    return F.expr(v)


def timestamp_value(ts: Column | str | _dt.datetime | None) -> Column:
    """Load/update timestamp: ``None`` = ``current_timestamp()``.

    A literal keeps loads deterministic and replayable (one value per batch).
    """
    if ts is None:
        return F.current_timestamp()
    if isinstance(ts, Column):
        return ts
    if isinstance(ts, _dt.datetime):
        ts = ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(ts))


def flag(pred: Column, passed: str = QUALITY_PASSED, failed: str = QUALITY_FAILED) -> Column:
    """``passed`` where ``pred`` is true; ``failed`` where false or NULL."""
    return F.when(pred, F.lit(passed)).otherwise(F.lit(failed))


def quality_predicate(
    client_id: str | Column = "client_id",
    complete_process: str | Column = "complete_process",
    id_length: int = CLIENT_ID_LENGTH,
    valid: Sequence[int] = VALID_COMPLETE_PROCESS,
) -> Column:
    return (F.length(col(client_id)) == id_length) & col(complete_process).isin(*valid)


def quality_check(**kw) -> Column:
    return flag(quality_predicate(**kw))


def map_values(c: str | Column, mapping: Mapping[str, str], default: str | Column | None = None) -> Column:
    """Chained CASE: mapped value, else ``default`` (NULL when not given)."""
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def bucket(
    c: str | Column,
    ranges: Iterable[tuple[int, int, str]] = AGE_BUCKETS,
    other: str = AGE_OTHER,
    null_label: str | None = None,
) -> Column:
    """Inclusive ``lo <= c <= hi`` buckets; everything else is ``other``.

    By default NULL also lands in ``other`` (as the reference does);
    ``null_label`` gives NULL its own label.
    """
    c = col(c)
    out = None
    if null_label is not None:
        out = F.when(c.isNull(), F.lit(null_label))
    for lo, hi, label in ranges:
        cond = (c >= lo) & (c <= hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(other))


def age_group(c: str | Column = "age", **kw) -> Column:
    return bucket(c, **kw)


def differs(a: Column, b: Column, mode: str = "strict") -> Column:
    """Change test of one column pair.

    ``strict``: SQL ``<>`` (NULL against a value is *not* a change: the
    three-valued result is NULL). ``null_safe``: ``NOT (a <=> b)``.
    """
    if mode == "strict":
        return a != b
    if mode == "null_safe":
        return ~a.eqNullSafe(b)
    raise ValueError(f"unknown change mode {mode!r}; use 'strict' or 'null_safe'")


def any_differs(pairs: Iterable[tuple[Column, Column]], mode: str = "strict") -> Column:
    """OR of ``differs`` over column pairs (a MERGE update condition)."""
    out = None
    for a, b in pairs:
        d = differs(a, b, mode)
        out = d if out is None else (out | d)
    if out is None:
        raise ValueError("no columns to compare")
    return out
