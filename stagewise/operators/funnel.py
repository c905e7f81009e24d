"""Funnel reports over the per-client stage-date table (one date column per stage).

Every report here is one grouped aggregate (map-side partial + final
HashAggregate, so only ``partitions x groups`` rows cross the shuffle)
followed by per-row arithmetic and a generator. Denominators come from
the same aggregated row or from a window over the few aggregated rows of
one state: no driver round trip, no self-join, no cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import age_group
from ..schemas import STAGES, Stage
from ..session import materialize as materialize_df


def _later(stages: Sequence[Stage], i: int) -> list[Column]:
    return [F.col(s.column) for s in stages[i:]]


def reached_exprs(stages: Sequence[Stage] = STAGES) -> list[Column]:
    """Cumulative counts: the first code counts every row; each later code
    counts rows where that stage or any later stage has a date."""
    out = []
    for i, s in enumerate(stages):
        if i == 0:
            out.append(F.count(F.lit(1)).alias(s.code))
        else:
            out.append(F.count(F.when(F.coalesce(*_later(stages, i)).isNotNull(), 1)).alias(s.code))
    return out


def reached(df: DataFrame, by: Sequence[str | Column] = (), stages: Sequence[Stage] = STAGES,
            ordered: bool = False) -> DataFrame:
    """One row per ``by`` group with one count column per stage code.

    A global ``reached(df)`` returns one row even on empty input (zeros).
    ``ordered`` sorts by the group columns, as the source reports.
    """
    aggs = reached_exprs(stages)
    if not by:
        return df.agg(*aggs)
    out = df.groupBy(*by).agg(*aggs)
    return out.orderBy(*by) if ordered else out


def furthest_exprs(stages: Sequence[Stage] = STAGES) -> list[Column]:
    """Mutually exclusive counts by furthest stage with a date; the first
    code means 'no later stage has a date' (the first stage itself is not
    tested)."""
    out = []
    for i, s in enumerate(stages):
        later_null = [F.col(x.column).isNull() for x in stages[i + 1:]]
        conds = ([F.col(s.column).isNotNull()] if i > 0 else []) + later_null
        cond = conds[0]
        for c in conds[1:]:
            cond = cond & c
        out.append(F.count(F.when(cond, 1)).alias(s.code))
    return out


def abandonment(df: DataFrame, stages: Sequence[Stage] = STAGES, complete_col: str = "complete_process") -> DataFrame:
    """A5: clients who did not complete (flag = 0), counted by furthest stage."""
    return df.filter(F.col(complete_col) == 0).agg(*furthest_exprs(stages))


def report_rows(ids: Sequence[str], fields: Sequence[Sequence[tuple[str, Column]]]) -> list[Column]:
    """``ids`` + ``inline(array(struct(...), ...))``: one output row per
    struct, in the given order (what ``stack`` does, for mixed measures)."""
    structs = [F.struct(*[c.alias(n) for n, c in f]) for f in fields]
    return [F.col(i) for i in ids] + [F.inline(F.array(*structs))]


def unpivot_counts(
    df: DataFrame,
    ids: Sequence[str] = (),
    stages: Sequence[Stage] = STAGES,
    name: str = "stage",
    value: str = "Total_users",
) -> DataFrame:
    """Count columns -> (stage, value) rows, in funnel order."""
    return df.unpivot(list(ids), [s.code for s in stages], name, value)


def pct(n: Column, total: Column, scale: int = 2) -> Column:
    """``round(n * 100.0 / total, scale)``; NULL (not an error) on total 0."""
    return F.round(F.try_divide(n * F.lit(100.0), total), scale)


def conversion_global(df: DataFrame, stages: Sequence[Stage] = STAGES, ordered: bool = False) -> DataFrame:
    """(stage, Total_by_stage, Percentage_conversion) over all clients;
    the denominator is the first stage's count of the same aggregated row.
    ``ordered`` sorts by percentage, highest first, as the source report."""
    out = conversion_global_from_counts(reached(df, (), stages), stages)
    return out.orderBy(F.col("Percentage_conversion").desc()) if ordered else out


def conversion_global_from_counts(counts: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    first = stages[0].code
    fields = [
        [("stage", F.lit(s.code)), ("Total_by_stage", F.col(s.code)),
         ("Percentage_conversion", pct(F.col(s.code), F.col(first)))]
        for s in stages
    ]
    return counts.select(*report_rows((), fields))


def conversion_per_state(df: DataFrame, stages: Sequence[Stage] = STAGES, state: str = "state") -> DataFrame:
    """(state, stage, Total_users, Percentage_conversion), the
    denominator being the state's first-stage count. NULL states are left
    out (an equi-join on state, as in the source report, never matches them)."""
    return conversion_per_state_from_counts(reached(df.filter(F.col(state).isNotNull()), [state], stages),
                                            stages, state)


def conversion_per_state_from_counts(counts: DataFrame, stages: Sequence[Stage] = STAGES,
                                     state: str = "state") -> DataFrame:
    first = stages[0].code
    fields = [
        [("stage", F.lit(s.code)), ("Total_users", F.col(s.code)),
         ("Percentage_conversion", pct(F.col(s.code), F.col(first)))]
        for s in stages
    ]
    return counts.filter(F.col(state).isNotNull()).select(*report_rows([state], fields))


def conversion_by_group(
    df: DataFrame,
    group: str = "Age_group",
    stages: Sequence[Stage] = STAGES,
    state: str = "state",
) -> DataFrame:
    """(state, group, stage, Total_users, Total_TI, Percentage_conversion)
    where Total_TI is the *state's* first-stage count over all groups.

    The state total is a window sum over the aggregated rows of one state
    (bounded by the number of group labels), not a join."""
    counts = reached(df.filter(F.col(state).isNotNull()), [state, group], stages)
    return conversion_by_group_from_counts(counts, group, stages, state)


def conversion_by_group_from_counts(counts: DataFrame, group: str = "Age_group",
                                    stages: Sequence[Stage] = STAGES, state: str = "state") -> DataFrame:
    first = stages[0].code
    counts = counts.filter(F.col(state).isNotNull())
    counts = counts.withColumn("Total_TI", F.sum(first).over(Window.partitionBy(state)))
    fields = [
        [("stage", F.lit(s.code)), ("Total_users", F.col(s.code)), ("Total_TI", F.col("Total_TI")),
         ("Percentage_conversion", pct(F.col(s.code), F.col("Total_TI")))]
        for s in stages
    ]
    return counts.select(*report_rows([state, group], fields))


def conversion_by_age(df: DataFrame, stages: Sequence[Stage] = STAGES, age: str = "age",
                      ordered: bool = False, **bucket_kw) -> DataFrame:
    """A16 with the reference's age buckets (``ordered``: by state, group, stage)."""
    out = conversion_by_group(df.withColumn("Age_group", age_group(age, **bucket_kw)), "Age_group", stages)
    return out.orderBy("state", "Age_group", "stage") if ordered else out


def funnel_state_age(df: DataFrame, stages: Sequence[Stage] = STAGES, age: str = "age", **bucket_kw) -> DataFrame:
    """Cumulative counts by state and age group."""
    return reached(df.withColumn("Age_group", age_group(age, **bucket_kw)), ["state", "Age_group"], stages)


def conversion_to_stage(df: DataFrame, code: str = "TCD", stages: Sequence[Stage] = STAGES) -> DataFrame:
    """Per-state share of clients reaching one stage (chart table)."""
    return conversion_per_state(df, stages).filter(F.col("stage") == code)


def dropoff(df: DataFrame, by: Sequence[str] = (), stages: Sequence[Stage] = STAGES) -> DataFrame:
    """For each consecutive stage pair, clients reaching the first, the
    next, the number lost and the loss as % of the first."""
    counts = reached(df, by, stages)
    fields = []
    for a, b in zip(stages, stages[1:]):
        lost = F.col(a.code) - F.col(b.code)
        fields.append([
            ("from_stage", F.lit(a.code)), ("to_stage", F.lit(b.code)),
            ("reached_from", F.col(a.code)), ("reached_to", F.col(b.code)),
            ("lost", lost), ("pct_lost", pct(lost, F.col(a.code))),
        ])
    return counts.select(*report_rows(list(by), fields))


def avg_days_per_stage(df: DataFrame, by: Sequence[str] = (), stages: Sequence[Stage] = STAGES) -> DataFrame:
    """Average days between consecutive stage dates, over the clients
    that have both dates (one aggregate pass, then one row per pair)."""
    aggs, fields = [], []
    for i, (a, b) in enumerate(zip(stages, stages[1:])):
        both = F.col(a.column).isNotNull() & F.col(b.column).isNotNull()
        days = F.datediff(F.col(b.column), F.col(a.column))
        aggs += [F.count(F.when(both, 1)).alias(f"n{i}"), F.avg(F.when(both, days)).alias(f"d{i}")]
        fields.append([
            ("from_stage", F.lit(a.code)), ("to_stage", F.lit(b.code)),
            ("n_clients", F.col(f"n{i}")), ("avg_days", F.col(f"d{i}")),
        ])
    counts = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return counts.select(*report_rows(list(by), fields))


def top_abandoned_stage(df: DataFrame, stages: Sequence[Stage] = STAGES, complete_col: str = "complete_process") -> DataFrame:
    """The furthest stage most often abandoned at (ties: earlier stage).

    The six counts live in one aggregated row, so the winner is a
    ``greatest`` over (count, -position) structs: no sort, no limit."""
    counts = abandonment(df, stages, complete_col)
    cands = [
        F.struct(F.col(s.code).alias("n"), F.lit(-i).alias("neg_pos"), F.lit(s.code).alias("stage"))
        for i, s in enumerate(stages)
    ]
    best = F.greatest(*cands)
    return counts.select(best.getField("stage").alias("stage"), best.getField("n").alias("Total_users"))


def funnel_rollup(df: DataFrame, stages: Sequence[Stage] = STAGES, age: str = "age",
                  materialize: bool = False, **bucket_kw) -> dict[str, DataFrame]:
    """A10-A12 and A14-A16 from the finest counts (state x age group: a few
    hundred rows at most); per-state and global counts are sums over them.

    With ``materialize`` those counts are written once to the shared scratch
    folder, so a dashboard refresh that uses several of the tables scans the
    big table once; without it no job runs until a table is used.
    """
    codes = [s.code for s in stages]
    fine = reached(df.withColumn("Age_group", age_group(age, **bucket_kw)), ["state", "Age_group"], stages)
    if materialize:
        fine = materialize_df(fine, "funnel-rollup")
    total = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in codes]
    by_state = fine.groupBy("state").agg(*total)
    overall = fine.agg(*total)
    return {
        "funnel_state_age": fine,
        "funnel_state": by_state,
        "funnel_global": overall,
        "conversion_global": conversion_global_from_counts(overall, stages),
        "conversion_per_state": conversion_per_state_from_counts(by_state, stages),
        "conversion_by_age": conversion_by_group_from_counts(fine, "Age_group", stages),
    }
