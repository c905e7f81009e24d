"""Queries of the operators over time: ordered funnels, frequent paths, catalog history.

Each is ``(spark, sf_dir) -> DataFrame`` over the fixture views, registered with those of
``fixture_queries``; the SQL of each is in ``oracle_sql.py``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dependencies as dp
from ..operators import funnel as fn
from ..operators import history as hs
from ..operators import labels as lb
from ..operators import paths as ps
from ..operators import rates as rt
from ..operators import sketches as sk
from ..operators import survival as sv
from ..operators.merge import dedupe_latest as dedupe_latest_op
from ..operators.pivot import map_stage
from ..schemas import STAGES
from ..session import materialize, scratch_dir
from ..sources import fixtures as fx
from . import gold
from .fixture_queries import funnel_enriched, stage_dates, write_drop
from .incremental import Layers, report_state, run_batch

WITHIN_DAYS = 365
MIN_SUPPORT = 0.1
PATH_LENGTH = 4
#: Catalog observations arrive in drops of load_no modulo this, the later ones first.
CATALOG_DROPS = 3
ATTRS = ("email", "state")
AS_OF = "2000-06-30"
GAP_KEYS = ["state", "from_stage", "to_stage"]
QUANTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95}


def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row of each client and stage. Unknown labels are NULL keys and all stay; rows of
    every 13th of a month lost their date and come last."""
    ev = map_stage(fx.funnel_events(spark, sf_dir))
    dated = ev.withColumn("register_date", F.when(F.dayofmonth("register_date") != 13, F.col("register_date")))
    return dedupe_latest_op(dated, ["client_id", "stage"], "register_date")


def ordered_funnel_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 in time order by state, within a year of the first stage."""
    ev = gold.enrich(fx.funnel_events(spark, sf_dir), fx.clients(spark, sf_dir))
    return ps.ordered_funnel(ev, WITHIN_DAYS, ["state"])


def ordered_funnel_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 in time order over all clients, without a limit of days."""
    return ps.ordered_funnel(fx.funnel_events(spark, sf_dir))


def frequent_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of up to four stages that a tenth of the clients took."""
    return ps.frequent_paths(fx.funnel_events(spark, sf_dir), MIN_SUPPORT, PATH_LENGTH)


def catalog_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity intervals of the catalog, spliced from drops that arrive out of order."""
    changes = fx.catalog_changes(spark, sf_dir)
    drops = [changes.where(F.col("load_no") / 5 % CATALOG_DROPS == d) for d in reversed(range(CATALOG_DROPS))]
    known = hs.history(drops[0], ["client_id"], ATTRS, "changed_on", "load_no")
    for drop in drops[1:]:
        known = hs.splice(known, drop, ["client_id"], ATTRS, "changed_on", "load_no")
    return known


def catalog_history_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's history with equal neighbours as one interval."""
    known = hs.history(fx.catalog_changes(spark, sf_dir), ["client_id"], ["state"], "changed_on", "load_no")
    return hs.collapsed(known, ["client_id"], ["state"])


def events_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 as of the event: each stage event with the attributes valid on its date."""
    known = hs.history(fx.catalog_changes(spark, sf_dir), ["client_id"], ATTRS, "changed_on", "load_no")
    return hs.asof_join(fx.funnel_events(spark, sf_dir), known, ["client_id"], "register_date", ATTRS)


def run_drops(spark: SparkSession, sf_dir: str, buckets: int = 4) -> Iterator[tuple[int, Layers]]:
    """Four scheduled runs with stored reports; yields after each of them."""
    base = scratch_dir(spark, "drops")
    for drop in range(1, fx.DROPS + 1):
        layers = Layers(f"{base}/landing{drop}", f"{base}/bronze", f"{base}/silver", f"{base}/gold", buckets, f"{base}/reports")
        write_drop(fx.funnel_drop(spark, sf_dir, drop), fx.clients_drop(spark, sf_dir, drop), layers.landing)
        run_batch(spark, layers, f"2024-0{drop}-01 00:00:00")
        yield drop, layers


def reports_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report sums by state, age group and flag after each of four drops, kept up from
    the changed clients only; late dates, moved states and new ages included."""
    parts = []
    for drop, layers in run_drops(spark, sf_dir):
        parts.append(materialize(report_state(spark, layers).counts().withColumn("drop", F.lit(drop)), "report-counts"))
    return reduce(DataFrame.unionByName, parts)


def survival_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5/X2 with open clients: time to completion by state, observed until AS_OF."""
    return sv.survival(stage_dates(spark, sf_dir), AS_OF, ["state"])


def survival_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days until a quarter of a state's clients have completed, open ones counted as open."""
    return sv.days_until(survival_state(spark, sf_dir), 0.25, ["state"])


def _batch_clients(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    return gold.client_stage_dates(fx.funnel_batch(spark, sf_dir, batch), fx.clients(spark, sf_dir))


def time_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact spread of the days between stages, by state, over both loads."""
    gaps = [sk.stage_gaps(_batch_clients(spark, sf_dir, b), ["state"]) for b in (1, 2)]
    return sk.exact_quantiles(gaps[0].unionByName(gaps[1]), GAP_KEYS, QUANTILES)


def time_quantiles_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from sketches that each load stored by state and app, merged upward to the state. Exact
    (and so equal to SQL) while a state has at most ``sketches.K`` clients between two stages."""
    root = scratch_dir(spark, "time-sketches")
    for batch in (1, 2):
        gaps = sk.stage_gaps(_batch_clients(spark, sf_dir, batch), ["state", "app"])
        sk.time_sketches(gaps, ["app", *GAP_KEYS]).write.parquet(f"{root}/load={batch}")
    stored = spark.read.parquet(root)
    return sk.sketch_quantiles(sk.merge_time_sketches(stored, GAP_KEYS), GAP_KEYS, QUANTILES)


def stage_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6/A9 over overlapping groups: clients in both, either or only the first of two stages, exact."""
    return sk.exact_overlap(fx.funnel_events(spark, sf_dir))


def stage_overlap_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from sets of clients stored by stage and month, merged over the months. Exact
    while a stage has at most 4096 clients."""
    months = fx.funnel_events(spark, sf_dir).withColumn("month", F.date_format("register_date", "yyyy-MM"))
    stored = materialize(sk.client_sketches(months, ["stage", "month"]), "client-sketches")
    return sk.overlap_from_sketches(sk.merge_client_sketches(stored, ["stage"]))


def propose_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What unknown stage labels stand for, within two edits; ambiguous and hopeless ones without proposal."""
    known = lb.canonical_labels(spark, [s.label for s in STAGES])
    out = lb.propose_labels(fx.misspelt_events(spark, sf_dir), "stage", known)
    return out.withColumn("nearest", F.array_join("nearest", "|"))


def map_stage_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 after the proposals: stage names of misspelt events, NULL for the rejects."""
    ev = fx.misspelt_events(spark, sf_dir)
    found = lb.propose_labels(ev, "stage", lb.canonical_labels(spark, [s.label for s in STAGES]))
    return map_stage(lb.with_proposals(ev, "stage", materialize(found, "labels")))


def differing_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States whose share of clients that reach the last stage differs from the whole, false discoveries
    held under a twentieth. The intervals, which SQL can't compute, are left out here and tested apart."""
    counts = fn.reached(stage_dates(spark, sf_dir), ["state"])
    return rt.differing_groups(counts, ["state"], "TCD", "TI").drop("low", "high")


def differing_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by state and age group, for the second stage."""
    counts = fn.funnel_state_age(stage_dates(spark, sf_dir))
    return rt.differing_groups(counts, ["state", "Age_group"], "TSD", "TI").drop("low", "high")


RULE_COLUMNS = ("client_id", "app", "state", "age", "stage", "complete_process")
RULE_ERROR = 0.02


def attribute_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All minimal rules of up to two columns that hold for 98 % of the catalog-joined stage events."""
    return dp.dependencies(funnel_enriched(spark, sf_dir), RULE_COLUMNS, 2, RULE_ERROR)


def moved_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where client_id -> state fails: clients with several states in the catalog's dated observations."""
    return dp.violating_keys(fx.catalog_changes(spark, sf_dir), ["client_id"], "state")


QUERIES = {f.__name__: f for f in (
    dedupe_latest, ordered_funnel_state, ordered_funnel_global, frequent_paths, catalog_history, catalog_history_collapsed, events_as_of,
    reports_kept_up, survival_state, survival_medians, time_quantiles, time_quantiles_sketched, stage_overlap,
    stage_overlap_sketched, propose_labels, map_stage_tolerant, differing_states, differing_ages, attribute_rules,
    moved_clients,
)}
