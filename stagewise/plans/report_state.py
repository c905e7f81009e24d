"""Reports kept up from changes (X6 with A5-A16 and X1): no rescan of the per-client table.

Every report over the per-client table is made of sums over clients by state, age group and
completion flag, so it can be kept as those sums. A run that changes clients adds, for each of
them, its new row with sign +1 and its old row with sign -1; rows that stay as they are cancel out.
Late dates, moved states and filled-in ages are thus taken out where they were counted and put in where they belong.

    <root>/log/run=<n>    signed rows of the clients that run n changed
    <root>/delta/run=<n>  their sums: a few hundred rows
    <root>/base/run=<n>   the sums of all runs up to n (``compact``, and the first scan of a table that was there before)

The log is written before the per-client table is touched, and its old rows are of before the
run. A run that dies after that is completed from its log by the next one: the table's MERGE of the
new rows and the sums (which replace those of the same run) give the same however often they are done. A folder
without Spark's ``_SUCCESS`` file is no folder. One writer per table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import age_group
from ..operators import funnel as fn
from ..operators.merge import Insert, Update
from ..operators.reports import COMPLETE, elapsed_days
from ..schemas import GOLD_PIVOT, STAGES, Stage
from ..session import delete_folder, finished_folders, materialize
from ..sources.tables import merge_into, read_table, table_exists

BY = ("state", "Age_group", COMPLETE)
LEFT = "left_"  # prefix of the counts by furthest stage


def additive(stages: Sequence[Stage] = STAGES) -> dict[str, Column]:
    """Sums over clients from which the reports are made: reached stages, furthest stages,
    days from first to last stage and between neighbours (sum and number of known ones)."""
    out = dict(zip([s.code for s in stages], fn.reached_exprs(stages)))
    out |= {LEFT + s.code: c for s, c in zip(stages, fn.furthest_exprs(stages))}
    gaps = [("days", elapsed_days())] + [(f"gap{i}", elapsed_days(b.column, a.column)) for i, (a, b) in enumerate(zip(stages, stages[1:]))]
    for name, days in gaps:
        out |= {f"{name}_n": F.count(days), f"{name}_sum": F.coalesce(F.sum(days), F.lit(0))}
    return {name: c.cast("bigint").alias(name) for name, c in out.items()}


def counted(clients: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """The sums of a per-client table by state, age group and flag."""
    return clients.withColumn("Age_group", age_group("age")).groupBy(*by).agg(*additive().values())


def signed_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of ``new`` with ``sign`` 1 and those of ``old`` with -1 that are not in both; equal rows cancel out by number."""
    both = new.withColumn("sign", F.lit(1)).unionByName(old.withColumn("sign", F.lit(-1)))
    return both.groupBy(*new.columns).agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0")


def _signed_sums(changes: DataFrame) -> DataFrame:
    sums = counted(changes.where(F.abs("sign") == 1), ("sign", *BY))
    return sums.groupBy(*BY).agg(*[F.sum(F.col("sign") * F.col(m)).cast("bigint").alias(m) for m in additive()])


class ReportState:
    """The stored sums of one per-client table (bucketed by client)."""

    def __init__(self, spark: SparkSession, root: str, clients: str, buckets: int):
        self.spark, self.root, self.clients, self.buckets = spark, root.rstrip("/"), clients, buckets

    def _path(self, kind: str, run: int) -> str:
        return f"{self.root}/{kind}/run={run}"

    def _runs(self, kind: str) -> list[int]:
        """Numbers of the finished folders: names only, one a run since the last ``compact``."""
        return sorted(int(n.removeprefix("run=")) for n in finished_folders(self.spark, f"{self.root}/{kind}"))

    def _write(self, df: DataFrame, kind: str, run: int) -> None:
        df.write.mode("overwrite").parquet(self._path(kind, run))

    def start(self) -> None:
        """Completes a run that died, and counts a per-client table that was there before the reports."""
        runs, bases = self._runs("log"), self._runs("base")
        if not bases:
            known = table_exists(self.spark, self.clients)
            rows = read_table(self.spark, self.clients, GOLD_PIVOT) if known else self.spark.createDataFrame([], GOLD_PIVOT)
            self._write(counted(rows).coalesce(1), "base", 0)
        elif runs and runs[-1] > max([*self._runs("delta"), bases[-1]]):
            self._finish(runs[-1])

    def apply(self, old: DataFrame, new: DataFrame) -> None:
        """Replaces ``old`` (rows of the per-client table) by ``new`` (one row a client), in the table and in the sums."""
        self.start()
        run = max([*self._runs("log"), self._runs("base")[-1]]) + 1
        self._write(signed_changes(old, new), "log", run)
        self._finish(run)

    def _finish(self, run: int) -> None:
        changes = self.spark.read.parquet(self._path("log", run)).select(*GOLD_PIVOT.fieldNames(), "sign")
        merge_into(self.spark, self.clients, changes.where("sign > 0").drop("sign"), ["client_id"], Update(), Insert(),
                   schema=GOLD_PIVOT, buckets=self.buckets, bucket_by=["client_id"])
        self._write(_signed_sums(changes).coalesce(1), "delta", run)

    def counts(self) -> DataFrame:
        """The sums by state, age group and flag: the last base and the deltas since, a few hundred rows each."""
        base = self._runs("base")[-1]
        paths = [self._path("base", base), *[self._path("delta", r) for r in self._runs("delta") if r > base]]
        rows = self.spark.read.parquet(*paths).select(*BY, *additive())
        total = rows.groupBy(*BY).agg(*[F.sum(m).cast("bigint").alias(m) for m in additive()])
        return total.where(F.col(STAGES[0].code) != 0)  # every client counts for the first stage

    def compact(self) -> None:
        """Writes the sums of all finished runs as one base and drops what it replaces."""
        self.start()
        runs, bases = self._runs("delta"), self._runs("base")
        if not runs or runs[-1] <= bases[-1]:
            return
        self._write(materialize(self.counts(), "report-base").coalesce(1), "base", runs[-1])
        for kind, old in (("delta", runs), ("log", self._runs("log")), ("base", bases)):
            for run in (r for r in old if r <= runs[-1]):
                delete_folder(self.spark, self._path(kind, run))


def report_tables(counts: DataFrame, stages: Sequence[Stage] = STAGES) -> dict[str, DataFrame]:
    """The reports from ``ReportState.counts``, equal to those computed from the per-client table."""
    codes = [s.code for s in stages]

    def summed(df: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
        sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in names]
        return df.groupBy(*by).agg(*sums) if by else df.agg(*sums)

    def clients(df: DataFrame, code: str) -> DataFrame:
        total = df.groupBy("state").agg(F.sum(code).cast("bigint").alias("Total_per_country"))
        return total.where("Total_per_country > 0")

    first, last = codes[0], codes[-1]
    done, open_ = counts.where(F.col(COMPLETE) == 1), counts.where(F.col(COMPLETE) == 0)
    by_state, by_age, overall = summed(counts, ["state"], codes), summed(counts, ["state", "Age_group"], codes), summed(counts, [], codes)
    left = summed(open_, [], [LEFT + c for c in codes]).select(*[F.col(LEFT + c).alias(c) for c in codes])
    gap_names = [f"gap{i}_{x}" for i in range(len(stages) - 1) for x in ("n", "sum")]
    gaps = [[("from_stage", F.lit(a.code)), ("to_stage", F.lit(b.code)), ("n_clients", F.col(f"gap{i}_n")),
             ("avg_days", F.try_divide(F.col(f"gap{i}_sum"), F.col(f"gap{i}_n")))] for i, (a, b) in enumerate(zip(stages, stages[1:]))]
    return {
        "funnel_global": overall, "funnel_state": by_state, "funnel_state_age": by_age,
        "conversion_global": fn.conversion_global_from_counts(overall, stages),
        "conversion_per_state": fn.conversion_per_state_from_counts(by_state, stages),
        "conversion_by_age": fn.conversion_by_group_from_counts(by_age, "Age_group", stages),
        "abandonment": left, "state_clients": clients(counts, first), "state_completed": clients(done, first),
        "state_open": clients(open_, first), "confirmed_not_complete": clients(open_, last),
        "avg_days_state": summed(done, ["state"], ["days_n", "days_sum"]).select("state", F.try_divide("days_sum", "days_n").alias("AV")),
        "avg_days_per_stage": summed(counts, [], gap_names).select(*fn.report_rows((), gaps)),
    }
