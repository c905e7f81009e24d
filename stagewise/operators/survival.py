"""Time to completion with clients that are still open (A5, X2): Kaplan-Meier curves.

Counting open clients as lost understates completion, as the youngest had the least time. Here each
client is at risk until it completes or, if it hasn't, until the day of observation (censored).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .reports import FIRST_STAGE, LAST_STAGE


def survival(clients: DataFrame, as_of: str | _dt.date | Column, by: Sequence[str] = (), start: str = FIRST_STAGE,
             end: str = LAST_STAGE) -> DataFrame:
    """Curve of each ``by`` group: ``day, at_risk, events, censored, survival, std_error``, one row a day (after
    ``start``) on which a client's time ended.

    ``survival`` is the estimated share of clients still open after that many days, ``std_error`` Greenwood's (NULL once
    nobody is left open). A client's time ends on ``end`` if that is known and not after ``as_of``, else it is censored on
    ``as_of``. Clients that start after ``as_of`` or not at all, or end before they start, have no time and are left out.

    One grouped aggregate (combined before the shuffle) leaves a row a group and day; the
    running sums over a group go over its days only, however many clients it has."""
    until = F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of
    seen = F.col(end).isNotNull() & (F.col(end) <= until)
    timed = clients.select(*by, F.datediff(F.when(seen, F.col(end)).otherwise(until), F.col(start)).alias("day"), F.coalesce(seen, F.lit(False)).alias("seen"))
    days = timed.where(F.col("day") >= 0).groupBy(*by, "day").agg(
        F.count(F.when(F.col("seen"), 1)).alias("events"), F.count(F.when(~F.col("seen"), 1)).alias("censored"))
    later = Window.partitionBy(*by).orderBy(F.desc("day"))
    before = Window.partitionBy(*by).orderBy("day")
    at_risk, events = F.col("at_risk"), F.col("events")
    d = days.withColumn("at_risk", F.sum(F.col("events") + F.col("censored")).over(later))
    none_left = F.max((events == at_risk).cast("int")).over(before) == 1
    log_share = F.sum(F.when(events < at_risk, F.log1p(-events / at_risk)).otherwise(0.0)).over(before)
    greenwood = F.sum(F.when(events < at_risk, events / (at_risk * (at_risk - events))).otherwise(0.0)).over(before)
    curve = F.when(none_left, F.lit(0.0)).otherwise(F.exp(log_share))
    return d.withColumns({"survival": curve, "std_error": F.when(~none_left, F.exp(log_share) * F.sqrt(greenwood))}).select(
        *by, "day", "at_risk", "events", "censored", "survival", "std_error")


def days_until(curve: DataFrame, share: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """First day of each ``survival`` curve on which the ``share`` of clients has completed: ``by, days`` (NULL: not reached)."""
    first = F.min(F.when(F.col("survival") <= 1 - share + 1e-12, F.col("day"))).alias("days")
    return curve.groupBy(*by).agg(first) if by else curve.agg(first)
