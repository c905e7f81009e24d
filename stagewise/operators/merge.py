"""MERGE as a DataFrame -> DataFrame operator (M1-M6).

``merge(target, source, on, when_matched=Update(...), when_not_matched=Insert(...))``
returns the merged table with the target's schema. Semantics follow SQL
MERGE on an equality key:

1. ``=`` on keys: a NULL key never matches. Such source rows are inserted
   (``null_keys='insert'``, the MERGE behaviour), dropped (``'drop'``) or
   rejected (``'error'``); such target rows pass through unchanged.
2. Update/insert conditions are three-valued: a NULL condition is false.
3. With an update clause, two source rows matching one target row raise
   ``AmbiguousMergeError``; insert-only merges insert every unmatched
   source row, duplicates included.
4. Target columns an insert does not name become NULL.

Values and conditions may be ``Column`` objects or SQL text referring to
``<target_alias>.col`` / ``<source_alias>.col``; ``'Null'`` is NULL (M6).

With an update clause the source is materialised once as parquet in the
session's shared scratch folder (under ``spark.checkpoint.dir``): the ambiguity
check and the merge see the same rows even if the source is non-deterministic.

Plan shape: an updating merge is one full outer join on the keys, so each side
is scanned and shuffled once. Its keys are unique on the source side (checked)
and on a keyed target's, so no key is hot; rows with a NULL key, which match
nothing, are spread by a salt that is part of the join key. An insert-only
merge is the target and an anti join that reads the target's key columns only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import any_differs, as_expr
from ..session import materialize

_S, _T, _SALT = "__merge_s", "__merge_t", "__merge_salt"
_SALTS = 64  # parts over which rows with a NULL key are spread


class AmbiguousMergeError(ValueError):
    """More than one source row matched one target row of an updating merge."""


class NullKeyError(ValueError):
    """A source row has a NULL merge key and ``null_keys='error'``."""


@dataclass(frozen=True)
class Update:
    """WHEN MATCHED [AND condition] THEN UPDATE SET ... (``set=None``: all
    target columns from the same-named source columns)."""

    set: Mapping[str, str | Column] | None = None
    condition: str | Column | None = None


@dataclass(frozen=True)
class Insert:
    """WHEN NOT MATCHED [AND condition] THEN INSERT ... (``values=None``:
    all target columns from the same-named source columns)."""

    values: Mapping[str, str | Column] | None = None
    condition: str | Column | None = None


def changed_condition(columns: Sequence[str], mode: str = "strict",
                      target_alias: str = "t", source_alias: str = "s") -> Column:
    """Update condition 'any of ``columns`` differs' (strict ``<>`` or null-safe)."""
    return any_differs(
        [(F.col(f"{target_alias}.{c}"), F.col(f"{source_alias}.{c}")) for c in columns], mode
    )


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _typed(expr: Column, dtype) -> Column:
    return expr.cast(dtype)


def _insert_cols(target: DataFrame, source: DataFrame, ins: Insert, sa: str) -> list[Column]:
    out = []
    for f in target.schema.fields:
        if ins.values is None:
            e = F.col(f"{sa}.{f.name}") if f.name.lower() in map(str.lower, source.columns) else F.lit(None)
        elif f.name in ins.values:
            e = as_expr(ins.values[f.name])
        else:
            e = F.lit(None)
        out.append(_typed(e, f.dataType).alias(f.name))
    return out


def ambiguous_keys(target: DataFrame, source: DataFrame, on: Sequence[str], limit: int = 5) -> list:
    """Sample keys (at most ``limit``) that occur more than once in the
    source and also in the target. One partial-aggregated pass over the
    source keys and a semi join with the target's key columns only."""
    keys = list(on)
    dups = (
        source.select(*keys).filter(~_any_null(keys))
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > 1).select(*keys)
    )
    if dups.isEmpty():  # the usual case: the target need not be read
        return []
    hit = dups.join(target.select(*keys).filter(~_any_null(keys)), keys, "left_semi")
    return [tuple(r) for r in hit.limit(limit).collect()]


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str] | str | Column,
    when_matched: Update | None = None,
    when_not_matched: Insert | None = Insert(),
    *,
    target_alias: str = "t",
    source_alias: str = "s",
    null_keys: str = "insert",
    check_ambiguous: bool = True,
    materialize_source: bool = True,
    allow_nested_loop: bool = False,
) -> DataFrame:
    """Merge ``source`` into ``target`` on equality of the ``on`` columns, or on a
    condition over both aliases (SQL text or a Column).

    A condition must hold an equality between the two sides, or every row would meet every
    other: one without is refused, unless ``allow_nested_loop`` says that one side is
    small. It takes no ``null_keys`` policy: rows match where it is true."""
    if null_keys not in ("insert", "drop", "error"):
        raise ValueError("null_keys must be 'insert', 'drop' or 'error'")
    if isinstance(on, (str, Column)):
        if null_keys != "insert":
            raise ValueError("null_keys needs key columns, not a condition")
        if not allow_nested_loop and not _has_equality(target, source, as_expr(on), target_alias, source_alias):
            raise ValueError("the merge condition holds no equality between target and source columns")
        return _merge_on_condition(target, source, on, when_matched, when_not_matched, target_alias, source_alias,
                                   check_ambiguous, materialize_source)
    keys = list(on)
    if when_matched is not None and materialize_source:
        source = materialize(source, "merge-source")
    ta, sa = target_alias, source_alias
    nullk = _any_null(keys)
    if null_keys == "error" and source.filter(nullk).limit(1).count():
        raise NullKeyError(f"source has rows with a NULL key in {keys}")
    if null_keys != "insert":
        source = source.filter(~nullk)
    if when_matched is None:
        if when_not_matched is None:
            return target
        return target.unionByName(
            merge_inserts(target, source, keys, when_not_matched, source_alias=sa, null_keys=null_keys))

    if check_ambiguous:
        sample = ambiguous_keys(target, source, keys)
        if sample:
            raise AmbiguousMergeError(
                f"several source rows match one target row for keys {keys}; e.g. {sample}"
            )

    def marked(df: DataFrame, name: str) -> DataFrame:
        salt = F.when(nullk, F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS))).otherwise(0)
        return df.withColumns({name: F.lit(True), _SALT: salt})

    t, s = marked(target, _T).alias(ta), marked(source, _S).alias(sa)
    key_eq = reduce(lambda a, b: a & b, [F.col(f"{ta}.{k}") == F.col(f"{sa}.{k}") for k in [*keys, _SALT]])
    return _joined_merge(target, source, t, s, key_eq, when_matched, when_not_matched, ta, sa)


def _has_equality(target: DataFrame, source: DataFrame, cond: Column, ta: str, sa: str) -> bool:
    """Whether the planner finds join keys in the condition (it plans a loop over all pairs otherwise)."""
    joined = target.alias(ta).join(source.alias(sa), cond, "full_outer")
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    return "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def _merge_on_condition(target: DataFrame, source: DataFrame, on: str | Column, upd: Update | None, ins: Insert | None,
                        ta: str, sa: str, check_ambiguous: bool, materialize_source: bool) -> DataFrame:
    if upd is None and ins is None:
        return target
    cond = as_expr(on)
    if upd is None:
        new_rows = source.alias(sa).join(target.alias(ta), cond, "left_anti")
        if ins.condition is not None:
            new_rows = new_rows.filter(F.coalesce(as_expr(ins.condition), F.lit(False)))
        return target.unionByName(new_rows.select(*_insert_cols(target, source, ins, sa)))
    if materialize_source:
        source = materialize(source, "merge-source")
    if check_ambiguous:
        # the ids live within this one job only
        numbered = target.withColumn(_T, F.monotonically_increasing_id()).alias(ta)
        hits = numbered.join(source.alias(sa), cond).groupBy(F.col(f"{ta}.{_T}")).agg(F.count(F.lit(1)).alias("n"))
        if not hits.filter("n > 1").isEmpty():
            raise AmbiguousMergeError("several source rows match one target row under the merge condition")
    t, s = target.withColumn(_T, F.lit(True)).alias(ta), source.withColumn(_S, F.lit(True)).alias(sa)
    return _joined_merge(target, source, t, s, cond, upd, ins, ta, sa)


def _joined_merge(target: DataFrame, source: DataFrame, t: DataFrame, s: DataFrame, key_eq: Column, upd: Update,
                  ins: Insert | None, ta: str, sa: str) -> DataFrame:
    """The updating merge as one full outer join of the marked sides."""
    if upd.set is None:
        named = {c.lower(): c for c in source.columns}
        missing = [c for c in target.columns if c.lower() not in named]
        if missing:
            raise ValueError(f"update-all needs every target column in the source; missing: {missing}")
        set_map = {c: F.col(f"{sa}.`{named[c.lower()]}`") for c in target.columns}
    else:
        set_map = upd.set
    in_target, in_source = F.col(f"{ta}.{_T}").isNotNull(), F.col(f"{sa}.{_S}").isNotNull()
    update = in_source if upd.condition is None else in_source & F.coalesce(as_expr(upd.condition), F.lit(False))
    joined = t.join(s, key_eq, "full_outer")
    if ins is None:
        joined = joined.filter(in_target)
    elif ins.condition is not None:
        joined = joined.filter(in_target | F.coalesce(as_expr(ins.condition), F.lit(False)))
    new = _insert_cols(target, source, ins, sa) if ins is not None else [F.lit(None)] * len(target.columns)
    cols = []
    for f, fresh in zip(target.schema.fields, new):
        kept = F.col(f"{ta}.{f.name}")
        if f.name in set_map:
            kept = F.when(update, _typed(as_expr(set_map[f.name]), f.dataType)).otherwise(kept)
        cols.append(F.when(in_target, kept).otherwise(fresh).alias(f.name))
    return joined.select(*cols)


def merge_inserts(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    when_not_matched: Insert = Insert(),
    *,
    source_alias: str = "s",
    null_keys: str = "insert",
) -> DataFrame:
    """Only the rows an insert-only merge adds (for append-only storage):
    the target is read for its key columns alone."""
    keys = list(on)
    nullk = _any_null(keys)
    sa = source_alias
    new_rows = source.filter(~nullk).join(target.select(*keys).filter(~nullk), keys, "left_anti")
    if null_keys == "insert":
        new_rows = new_rows.unionByName(source.filter(nullk))
    elif null_keys == "error" and source.filter(nullk).limit(1).count():
        raise NullKeyError(f"source has rows with a NULL key in {keys}")
    new_rows = new_rows.alias(sa)
    if when_not_matched.condition is not None:
        new_rows = new_rows.filter(F.coalesce(as_expr(when_not_matched.condition), F.lit(False)))
    return new_rows.select(*_insert_cols(target, source, when_not_matched, sa))


def upsert_all(target: DataFrame, source: DataFrame, on: Sequence[str], **kw) -> DataFrame:
    """M1: matched -> every column from the source; unmatched -> insert all."""
    return merge(target, source, on, Update(), Insert(), **kw)


def insert_only(target: DataFrame, source: DataFrame, on: Sequence[str],
                values: Mapping[str, str | Column] | None = None, **kw) -> DataFrame:
    """M2/M4: insert source rows whose key is absent; never touch existing rows."""
    return merge(target, source, on, None, Insert(values), **kw)


def dedupe_latest(df: DataFrame, on: Sequence[str], order_by: str | None = None) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order_by``.

    A NULL ``order_by`` comes after all others, equal ones fall to the greatest
    row by its columns in order, as they all do without ``order_by``. A row with a
    NULL in its key equals no other and stays. All columns must be orderable.

    The maximum of a struct is an ordinary aggregate with a partial (map-side)
    phase, so a hot key is reduced before the shuffle instead of being sorted in
    one window partition."""
    keys, nullk = list(on), _any_null(on)
    order = [] if order_by is None else [F.col(order_by).isNotNull().alias("a"), F.col(order_by).alias("b")]
    best = F.max(F.struct(*order, F.struct(*[F.col(c) for c in df.columns]).alias("row"))).alias("__r")
    kept = df.filter(~nullk).groupBy(*keys).agg(best).select("__r.row.*")
    return kept.unionByName(df.filter(nullk))
