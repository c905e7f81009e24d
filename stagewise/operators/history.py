"""History of a keyed catalog as validity intervals, and joins as of a date.

The catalog MERGE overwrites attributes, so a report over past events sees today's
values. ``splice`` keeps them instead: every observation (key, time it is valid from,
attributes) is one row of the history, valid until the next one of its key. A late
observation closes the interval that it falls into and starts its own, which ends where the
next one begins; only the keys of the new observations are touched. Observations are kept even if
they repeat the attributes of the one before (a later late one may come between them), so
the same drops in any order give the same history; ``collapsed`` joins equal neighbours for readers.

``asof_join`` gives each row the attributes valid at its time, without a range join: both
sides are put together, ordered by time, and the last observation is carried forward. A key's
rows are cut into blocks of time and the state at the start of each block is carried over by a
window over one row a block, so a key that holds a third of all rows is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def _no_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _intervals(observations: DataFrame, on: Sequence[str], attrs: Sequence[str], stamp: str) -> DataFrame:
    """One row per key and time, valid until the key's next one. Of observations of one key and time
    the one with the latest stamp counts (no stamp first), then the greatest by its attributes."""
    best = F.max(F.struct(F.col(stamp).isNotNull().alias("a"), F.col(stamp).alias("b"), F.struct(*attrs).alias("attrs"))).alias("__o")
    rows = observations.groupBy(*on, VALID_FROM).agg(best)
    following = F.lead(VALID_FROM).over(Window.partitionBy(*on).orderBy(VALID_FROM))
    return rows.select(*on, *[F.col(f"__o.attrs.{a}").alias(a) for a in attrs], F.col("__o.b").alias(stamp), VALID_FROM,
                       following.alias(VALID_TO))


def history(observations: DataFrame, on: Sequence[str], attrs: Sequence[str], at: str, stamp: str) -> DataFrame:
    """The history of all ``observations``: ``on``, ``attrs``, ``stamp``, ``valid_from``, ``valid_to`` (exclusive; NULL: still valid).

    Rows with a NULL key or time have no place in it and are left out. A key's observations of different times are sorted in
    one task: they are bounded by the days (or instants) on which one key changes, not by how often it is loaded."""
    o = observations.select(*on, *attrs, stamp, F.col(at).alias(VALID_FROM)).where(_no_null([*on, VALID_FROM]))
    return _intervals(o, on, attrs, stamp)


def splice(known: DataFrame, observations: DataFrame, on: Sequence[str], attrs: Sequence[str], at: str, stamp: str) -> DataFrame:
    """``known`` (a history) with new observations, late ones included: the keys that have some are built again
    from their old and new observations, all others pass through. Splicing the same drop again changes nothing."""
    new = observations.select(*on, *attrs, stamp, F.col(at).alias(VALID_FROM)).where(_no_null([*on, VALID_FROM]))
    keys = new.select(*on).distinct()
    old = known.join(keys, list(on), "left_semi").select(*new.columns)
    return known.join(keys, list(on), "left_anti").unionByName(_intervals(old.unionByName(new), on, attrs, stamp))


def collapsed(known: DataFrame, on: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """The history with neighbours of equal attributes (NULLs equal) as one interval: ``on``, ``attrs``,
    ``valid_from``, ``valid_to``, ``is_current``."""
    w = Window.partitionBy(*on).orderBy(VALID_FROM)
    now, before = F.struct(*attrs), F.lag(F.struct(*attrs)).over(w)
    starts = known.withColumn("__new", ~now.eqNullSafe(before)).withColumn("__run", F.sum(F.col("__new").cast("int")).over(w))
    same = starts.groupBy(*on, "__run").agg(*[F.first(a).alias(a) for a in attrs], F.min(VALID_FROM).alias(VALID_FROM),
                                            F.max(F.struct(F.col(VALID_TO).isNull().alias("a"), F.col(VALID_TO).alias("b")))["b"].alias(VALID_TO))
    return same.select(*on, *attrs, VALID_FROM, VALID_TO, F.col(VALID_TO).isNull().alias("is_current"))


def asof_join(rows: DataFrame, known: DataFrame, on: Sequence[str], at: str, attrs: Sequence[str], block: str = "month") -> DataFrame:
    """Every row of ``rows`` with the ``attrs`` of ``known`` valid at its time ``at``; NULLs where there are none
    (no observation yet, or a NULL key or time).

    ``known`` holds one row per key and ``valid_from``, each valid until the next (a history). ``block``: the unit of time
    (``date_trunc``) into which a key's rows are cut. One shuffle of both sides by key and block serves the window and the
    join with the blocks' first states; a row of ``known`` counts from its ``valid_from`` on, that instant included."""
    clash = set(map(str.lower, rows.columns)) & set(map(str.lower, attrs))
    if clash:
        raise ValueError(f"rows already have columns {sorted(clash)}")
    cut = F.date_trunc(block, F.col("__at").cast("timestamp"))
    left = rows.select(F.struct(*rows.columns).alias("__row"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(on)],
                       F.col(at).alias("__at"), F.lit(1).alias("__side"), F.lit(None).alias("__attrs"))
    right = known.where(_no_null([*on, VALID_FROM])).select(
        F.lit(None).alias("__row"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(on)], F.col(VALID_FROM).alias("__at"),
        F.lit(0).alias("__side"), F.struct(*attrs).alias("__attrs"))
    keys = [f"__k{i}" for i in range(len(on))]
    # rows without a key or time meet no observation: they are not shuffled to one place
    placed = left.where(_no_null([*keys, "__at"]))
    lost = left.where(~_no_null([*keys, "__at"])).select("__row.*", *[F.lit(None).cast(known.schema[a].dataType).alias(a) for a in attrs])
    both = placed.unionByName(right).withColumn("__block", cut)
    # the last observation of each block, and from it the state at the start of the next blocks
    last = F.max(F.when(F.col("__side") == 0, F.struct("__at", "__attrs")))["__attrs"].alias("__last")
    blocks = both.groupBy(*keys, "__block").agg(last)
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    first = blocks.select(*keys, "__block", F.last("__last", ignorenulls=True).over(earlier).alias("__first"))
    within = Window.partitionBy(*keys, "__block").orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("__now", F.last("__attrs", ignorenulls=True).over(within)).where(F.col("__side") == 1)
    joined = carried.join(first, [*keys, "__block"]).withColumn("__now", F.coalesce("__now", "__first"))
    out = joined.select("__row.*", *[F.col(f"__now.{a}").alias(a) for a in attrs])
    return out.unionByName(lost)
