"""Which groups differ (A15, A16): exact intervals of conversion rates and control of false discoveries.

The conversion reports list hundreds of groups, and some look unlike the rest by chance alone. Here each group gets the exact
(Clopper-Pearson) interval of its rate and the exact p-value of having the same rate as all clients; the step-up rule of
Benjamini and Hochberg then flags as many groups as it can while the expected share of false ones stays under a limit.

Input are the few rows of an aggregated report, so the numeric part runs on counts, not clients.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CONFIDENCE = 0.95
FALSE_SHARE = 0.05


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function: the share of the Beta(a, b) distribution under ``x``, by
    its continued fraction, whose length doesn't grow with the counts."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_share(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / max(abs(1 - (a + b) * x / (a + 1)), tiny) * (1 if 1 - (a + b) * x / (a + 1) >= 0 else -1)
    value = d
    for m in range(1, 100_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + step * d
            c = 1 + step / c
            d = 1 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return min(max(front * value, 0.0), 1.0)


def at_least(k: int, n: int, p: float) -> float:
    """Chance of ``k`` or more successes in ``n`` trials of chance ``p``."""
    return 1.0 if k <= 0 else 0.0 if k > n else beta_share(k, n - k + 1, p)


def interval(k: int, n: int, confidence: float = CONFIDENCE) -> tuple[float, float]:
    """Clopper-Pearson interval of the rate k / n: the rates under which neither tail is rarer than asked."""
    tail = (1 - confidence) / 2

    def solve(share) -> float:
        low, high = 0.0, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if share(mid) < tail else (low, mid)
        return (low + high) / 2

    lower = 0.0 if k == 0 else solve(lambda p: at_least(k, n, p))
    upper = 1.0 if k == n else 1 - solve(lambda p: 1 - at_least(k + 1, n, 1 - p))
    return lower, upper


def two_sided(k: int, n: int, p: float) -> float:
    """Exact p-value of ``k`` in ``n`` under the rate ``p``: twice the smaller tail, 1 at most."""
    return min(1.0, 2 * min(at_least(k, n, p), 1 - at_least(k + 1, n, p)))


def differing_groups(counts: DataFrame, by: Sequence[str], reached: str, total: str, confidence: float = CONFIDENCE,
                     false_share: float = FALSE_SHARE) -> DataFrame:
    """``by, n, k, rate, low, high, p_value, rank, flagged``: each group's rate of ``reached`` in ``total``, its interval,
    and whether it differs from the rate of all groups together.

    ``rank`` orders the groups by p-value (equal ones share the larger rank), and a group is flagged if it or a
    group after it has ``p_value <= false_share * rank / groups``. Groups without clients are left out. Rows are one a group; the
    window over all of them sorts report rows in one task, as a report of them would be read."""
    rows = counts.groupBy(*by).agg(F.sum(total).cast("bigint").alias("n"), F.sum(reached).cast("bigint").alias("k")).where("n > 0")
    everything = Window.partitionBy()
    rows = rows.withColumn("__p", F.sum("k").over(everything) / F.sum("n").over(everything))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            bounds = [interval(int(k), int(n), confidence) for k, n in zip(f["k"], f["n"])]
            yield f.drop(columns="__p").assign(
                rate=f["k"] / f["n"], low=[x for x, _ in bounds], high=[x for _, x in bounds],
                p_value=[two_sided(int(k), int(n), p) for k, n, p in zip(f["k"], f["n"], f["__p"])])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__p").schema.fields)
    tested = rows.mapInPandas(run, fields + ", rate double, low double, high double, p_value double")
    up_to = Window.partitionBy().orderBy("p_value").rangeBetween(Window.unboundedPreceding, 0)
    from_here = Window.partitionBy().orderBy("p_value").rangeBetween(0, Window.unboundedFollowing)
    ranked = tested.withColumn("rank", F.count(F.lit(1)).over(up_to)).withColumn("__groups", F.count(F.lit(1)).over(everything))
    passes = F.col("p_value") <= F.lit(false_share) * F.col("rank") / F.col("__groups")
    return ranked.withColumn("flagged", F.max(passes).over(from_here)).drop("__groups")
