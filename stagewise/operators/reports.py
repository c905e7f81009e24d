"""Completion reports over the per-client stage-date table.

Each is filter (pushed to the scan when the table is stored) + grouped
aggregate. Report ordering is opt-in (``ordered=True``): a global sort is
an extra range shuffle that a consumer rarely needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPLETE = "complete_process"
FIRST_STAGE = "introduction"
LAST_STAGE = "data_confirmation"


def completed(df: DataFrame, flag: int = 1) -> DataFrame:
    """Rows whose completion flag equals ``flag``."""
    return df.filter(F.col(COMPLETE) == flag)


def confirmed_not_complete_rows(df: DataFrame) -> DataFrame:
    """Flag 0 although the last stage has a date."""
    return df.filter((F.col(COMPLETE) == 0) & F.col(LAST_STAGE).isNotNull())


def count_rows(df: DataFrame, name: str) -> DataFrame:
    """A2/A3: one-row ``count(*)`` named ``name`` (the column, not the frame)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def finished_all(df: DataFrame) -> DataFrame:
    return count_rows(completed(df, 1), "finished_all")


def didnt_finish_all(df: DataFrame) -> DataFrame:
    return count_rows(completed(df, 0), "didnt_finish_all")


def count_by(df: DataFrame, by: Sequence[str] = ("state",), name: str = "Total_per_country",
             ordered: bool = False) -> DataFrame:
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.col(name).desc()) if ordered else out


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """O3: the first ``n`` rows in the given order (top-k per task, then of those)."""
    return df.orderBy(*order).limit(n)


def state_completed(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Clients per state that completed."""
    return count_by(completed(df, 1), ordered=ordered)


def state_open(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Clients per state that did not complete."""
    return count_by(completed(df, 0), ordered=ordered)


def confirmed_not_complete(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Per state, flag 0 with a confirmation date."""
    return count_by(confirmed_not_complete_rows(df), ordered=ordered)


def state_clients(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Clients per state."""
    return count_by(df, ordered=ordered)


def elapsed_days(end: str | Column = LAST_STAGE, start: str | Column = FIRST_STAGE) -> Column:
    end = F.col(end) if isinstance(end, str) else end
    start = F.col(start) if isinstance(start, str) else start
    return F.datediff(end, start)


def avg_days_state(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Completed clients, average days first -> last stage per state
    (rows missing either date are skipped; a state with none gives NULL)."""
    out = completed(df, 1).groupBy("state").agg(F.avg(elapsed_days()).alias("AV"))
    return out.orderBy(F.col("AV").desc()) if ordered else out


def total_time(df: DataFrame, ordered: bool = False, unique_clients: bool = False) -> DataFrame:
    """A4: completed clients: last confirmation, first introduction and the
    days between (NULL if either is missing; negative when out of order).

    The grouping by client merges a client split over several rows (as the
    source's 7-column pivot can produce); when the table is known to hold
    one row per client (``run_batch`` in null-safe mode guarantees it),
    ``unique_clients=True`` gives the same rows without that shuffle."""
    done = completed(df, 1)
    if unique_clients:
        out = done.select("client_id", COMPLETE, F.col(LAST_STAGE).alias("max"), F.col(FIRST_STAGE).alias("min"))
    else:
        out = done.groupBy("client_id", COMPLETE).agg(F.max(LAST_STAGE).alias("max"), F.min(FIRST_STAGE).alias("min"))
    out = out.withColumn("total_time_days", F.datediff(F.col("max"), F.col("min")))
    return out.orderBy("client_id") if ordered else out
