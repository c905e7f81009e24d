"""Stage events in time order: strict funnels within days (A10) and frequent paths.

Both start from ``client_paths``: one row per client with its events as a sorted array of
``(day, position of the stage)``. Equal events of one day are one, dropped in the map-side
phase of the aggregate, so an array holds at most one element a stage and day, however
many rows a client has. Events of one day are taken in funnel order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import STAGES, Stage
from ..session import drop_materialized, materialize

#: A level's frequent paths are broadcast up to this many (some 50 bytes each).
BROADCAST_PATHS = 500_000


def stage_position(stage: str | Column = "stage", stages: Sequence[Stage] = STAGES) -> Column:
    """0, 1, ... for the funnel's labels in order; NULL for an unknown or missing label."""
    c = F.col(stage) if isinstance(stage, str) else stage
    out = F.lit(None).cast("int")
    for i, s in reversed(list(enumerate(stages))):
        out = F.when(c == s.label, F.lit(i)).otherwise(out)
    return out


def client_paths(events: DataFrame, by: Sequence[str] = ("client_id",), stage: str = "stage", date: str = "register_date",
                 stages: Sequence[Stage] = STAGES) -> DataFrame:
    """``by`` columns and ``path``: the sorted array of ``(day, position)`` of each client.

    Events without a known stage or a date have no place in time and are left
    out; so is a client that has no others. A NULL client is one group like any other."""
    placed = events.select(*by, F.col(date).cast("date").alias("day"), stage_position(stage, stages).alias("position"))
    placed = placed.where(F.col("day").isNotNull() & F.col("position").isNotNull())
    return placed.groupBy(*by).agg(F.sort_array(F.collect_set(F.struct("day", "position"))).alias("path"))


def ordered_depth(path: str | Column = "path", within_days: int | None = None, stages: Sequence[Stage] = STAGES) -> Column:
    """How many first stages a client passed in funnel order, all within ``within_days`` of the first.

    One fold over the sorted events keeps, for each stage, the latest start of a
    run that has come so far: a later start leaves more days, so no other run need be
    kept. The first stage starts a run again whenever it comes back; any other event
    moves the run of the stage before it on, if that run's start is near enough."""
    p = F.col(path) if isinstance(path, str) else path
    start = F.array(*[F.lit(None).cast("date") for _ in stages])

    def step(runs: Column, e: Column) -> Column:
        i = e["position"]
        before = F.when(i == 0, e["day"]).otherwise(F.get(runs, i - 1))
        near = F.lit(True) if within_days is None else F.datediff(e["day"], before) <= within_days
        moved = F.when(before.isNotNull() & near, before)
        return F.transform(runs, lambda at, k: F.when((k == i) & moved.isNotNull(), moved).otherwise(at))

    return F.size(F.filter(F.aggregate(p, start, step), lambda at: at.isNotNull()))


def ordered_funnel(events: DataFrame, within_days: int | None = None, by: Sequence[str] = (), client: str = "client_id",
                   stages: Sequence[Stage] = STAGES, **columns) -> DataFrame:
    """A10 in time order: one count column per stage code, a client counting for a stage if it passed that and
    all before it in order, within ``within_days`` of the first one (None: without limit).

    ``by``: columns of ``events`` that are part of the client's key. Without ``by`` there is one row, zeros on empty input."""
    paths = client_paths(events, [*by, client], stages=stages, **columns)
    depth = paths.select(*by, ordered_depth("path", within_days, stages).alias("depth"))
    counts = [F.count(F.when(F.col("depth") > i, 1)).alias(s.code) for i, s in enumerate(stages)]
    return depth.groupBy(*by).agg(*counts) if by else depth.agg(*counts)


def frequent_paths(events: DataFrame, min_support: float, max_length: int | None = None, client: str = "client_id",
                   stages: Sequence[Stage] = STAGES, **columns) -> DataFrame:
    """Every path (stages in time order, others may lie between) that at least the share ``min_support`` of
    all clients with a placed event took: ``(path, length, clients, support)``, codes joined by ``>``.

    Pattern growth by prefix projection: a level's rows are ``(client's events, path, end)``, ``end`` being the place where
    the path is first complete in the events. A row grows by each stage that comes later, at its first place after ``end``, so a
    client is one row a path. Only counts of grown paths are shuffled (partial sums), and the next level starts from the
    frequent ones: rows of the others end before anything is written or shuffled, as the frequent paths are broadcast while
    they are few (``BROADCAST_PATHS``, counted); beyond that the join is a shuffle, whose hot paths AQE splits."""
    if not 0 < min_support <= 1:
        raise ValueError("min_support must be over 0 and at most 1")
    spark = events.sparkSession
    codes = F.array(*[F.lit(s.code) for s in stages])
    paths = client_paths(events, [client], stages=stages, **columns)
    base = materialize(paths.select(F.transform("path", lambda e: e["position"]).alias("seq")), "paths")
    total = base.count()
    least = total * min_support
    level = base.select("seq", F.lit("").alias("path"), F.lit(0).alias("end"))
    found, parts, length = [], [], 0
    while total and (max_length is None or length < max_length):
        length += 1
        later = F.transform(F.sequence(F.lit(0), F.lit(len(stages) - 1)),
                            lambda p: F.struct(p.alias("stage"), F.array_position(F.slice("seq", F.col("end") + 1, F.size("seq")), p).alias("at")))
        grown = level.select("seq", "path", "end", F.explode(F.filter(later, lambda x: x["at"] > 0)).alias("x"))
        name = F.concat(F.when(F.col("path") == "", "").otherwise(F.concat("path", F.lit(">"))), codes[F.col("x.stage")])
        grown = grown.select("seq", name.alias("path"), (F.col("end") + F.col("x.at").cast("int")).alias("end"))
        counts = grown.groupBy("path").agg(F.count(F.lit(1)).alias("clients")).where(F.col("clients") >= least)
        counts = materialize(counts.select("path", F.lit(length).alias("length"), "clients", (F.col("clients") / F.lit(total)).alias("support")), "level")
        found.append(counts)
        n = counts.count()
        if not n:
            break
        kept = counts.select("path")
        level = materialize(grown.join(F.broadcast(kept) if n <= BROADCAST_PATHS else kept, "path", "left_semi").select("seq", "path", "end"), "level-rows")
        parts.append(level)
    for p in [base, *parts]:
        drop_materialized(p)
    out = spark.createDataFrame([], "path string, length int, clients bigint, support double")
    for f in found:
        out = out.unionByName(f)
    return out
