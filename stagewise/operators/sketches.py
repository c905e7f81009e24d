"""Stored sketches that are merged upward: spread of times (X1, A4, A8) and overlapping groups of clients.

Averages and counts of distinct clients can't be added up over loads, states or months: a client may be in several. These
sketches can. Each load writes one small row a group, and any coarser report merges rows instead of
scanning clients. Both kinds are Spark's own (KLL and theta sketches); the exact forms stand beside them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import STAGES, Stage
from .paths import stage_position

#: Items of a KLL sketch: ranks are within about 1.65 % (2.296 / K**0.9021, at 99 % confidence); up to K values it is exact.
K = 200
#: log2 of a theta sketch's entries: counts of unions are within 2 / sqrt(2**LG) of the union's size at 95 %
#: confidence, and so are intersections and differences (of the union's, not their own, size); exact up to 2**LG clients.
LG = 12


def rank_error(k: int = K) -> float:
    """Largest distance between the true and the asked rank of a sketch's quantile, at 99 % confidence."""
    return 2.296 / k**0.9021


def stage_gaps(clients: DataFrame, keep: Sequence[str] = (), stages: Sequence[Stage] = STAGES) -> DataFrame:
    """``keep`` columns, ``from_stage, to_stage, days`` of each client and neighbouring stages with both dates."""
    each = [F.struct(F.lit(a.code).alias("from_stage"), F.lit(b.code).alias("to_stage"), F.datediff(b.column, a.column).alias("days"))
            for a, b in zip(stages, stages[1:])]
    return clients.select(*keep, F.inline(F.array(*each))).where(F.col("days").isNotNull())


def time_sketches(gaps: DataFrame, by: Sequence[str], value: str = "days", k: int = K) -> DataFrame:
    """``by, n, sketch``: the values' distribution in each group, a few KB however many there are."""
    v = F.col(value).cast("bigint")
    return gaps.groupBy(*by).agg(F.count(v).alias("n"), F.kll_sketch_agg_bigint(v, k).alias("sketch"))


def merge_time_sketches(sketches: DataFrame, by: Sequence[str], k: int = K) -> DataFrame:
    """Sketches of coarser groups from stored ones, in whatever order they come."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", k).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, by: Sequence[str], at: Mapping[str, float]) -> DataFrame:
    """``by, n`` and one column a quantile (``{name: rank}``); groups without values are left out."""
    return sketches.where("n > 0").select(*by, "n", *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(name) for name, q in at.items()])


def exact_quantiles(gaps: DataFrame, by: Sequence[str], at: Mapping[str, float], value: str = "days") -> DataFrame:
    """The same with exact ranks. The aggregate holds counts of distinct values, which for days are few."""
    cols = [F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY `{value}`)").cast("bigint").alias(name) for name, q in at.items()]
    return gaps.groupBy(*by).agg(F.count(value).alias("n"), *cols).where("n > 0")


def client_sketches(events: DataFrame, by: Sequence[str], client: str = "client_id", lg: int = LG) -> DataFrame:
    """``by, sketch``: the set of clients in each group (NULL clients are in none)."""
    return events.groupBy(*by).agg(F.theta_sketch_agg(F.col(client), lg).alias("sketch"))


def merge_client_sketches(sketches: DataFrame, by: Sequence[str], lg: int = LG) -> DataFrame:
    """The union of stored sets by coarser groups: a client in several is one."""
    return sketches.groupBy(*by).agg(F.theta_union_agg("sketch", lg).alias("sketch"))


def _pairs(stages: Sequence[Stage]) -> list[tuple[Stage, Stage]]:
    return list(combinations(stages, 2))


def overlap_from_sketches(sketches: DataFrame, by: Sequence[str] = (), stages: Sequence[Stage] = STAGES) -> DataFrame:
    """For each pair of stages, from one set a stage (``by, stage, sketch``): ``by, first_stage, second_stage,
    in_first, in_second, in_both, in_either, first_only`` as estimated numbers of clients."""
    cols = [F.max(F.when(F.col("stage") == s.label, F.col("sketch"))).alias(s.code) for s in stages]
    wide = sketches.groupBy(*by).agg(*cols) if by else sketches.agg(*cols)
    size = lambda s: F.coalesce(F.theta_sketch_estimate(s), F.lit(0))
    each = []
    for a, b in _pairs(stages):
        x, y = F.col(a.code), F.col(b.code)
        # a stage nobody came to has no set
        both, only = F.theta_intersection(x, y), F.when(y.isNull(), x).otherwise(F.theta_difference(x, y))
        each.append(F.struct(F.lit(a.code).alias("first_stage"), F.lit(b.code).alias("second_stage"), size(x).alias("in_first"),
                             size(y).alias("in_second"), size(both).alias("in_both"),
                             size(F.coalesce(F.theta_union(x, y), x, y)).alias("in_either"), size(only).alias("first_only")))
    return wide.select(*by, F.inline(F.array(*each)))


def exact_overlap(events: DataFrame, by: Sequence[str] = (), client: str = "client_id", stages: Sequence[Stage] = STAGES) -> DataFrame:
    """The same, exact: a client is a bit mask of its stages, and clients are counted by mask (64 at most)
    before any pair is looked at."""
    placed = events.where(F.col(client).isNotNull()).select(*by, client, stage_position("stage", stages).alias("p"))
    masks = placed.where("p IS NOT NULL").groupBy(*by, client).agg(F.bit_or(F.expr("shiftleft(1, p)")).alias("mask"))
    by_mask = masks.groupBy(*by, "mask").agg(F.count(F.lit(1)).alias("n"))
    has = {s.code: F.col("mask").bitwiseAND(1 << i) != 0 for i, s in enumerate(stages)}
    aggs, each = [], []
    for i, (a, b) in enumerate(_pairs(stages)):
        x, y = has[a.code], has[b.code]
        parts = {"in_first": x, "in_second": y, "in_both": x & y, "in_either": x | y, "first_only": x & ~y}
        aggs += [F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(f"{name}{i}") for name, c in parts.items()]
        each.append(F.struct(F.lit(a.code).alias("first_stage"), F.lit(b.code).alias("second_stage"), *[F.col(f"{name}{i}").alias(name) for name in parts]))
    wide = by_mask.groupBy(*by).agg(*aggs) if by else by_mask.agg(*aggs)
    return wide.select(*by, F.inline(F.array(*each)))
