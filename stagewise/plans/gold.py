"""Silver -> gold plans: enrich funnel rows with the catalog (J1, P5) and
build the per-client stage-date table (A1) the reports read.

Two plans give the same per-client table:

* ``stage_dates_from_enriched`` follows the source order: join every stage
  row to the catalog, then pivot grouped by the seven client columns.
* ``client_stage_dates`` pivots the narrow funnel rows by
  (client_id, complete_process, app) first, then joins the catalog. The
  pivot's partial aggregation collapses a client's rows (also a hot
  client holding a third of the input) before the only large shuffle,
  and the wide catalog strings are shuffled once per client instead of
  once per stage row. The catalog is de-duplicated on all its columns
  first so an exact duplicate catalog row cannot double a client
  (grouping on the seven columns would merge them); the catalog is hash
  partitioned on client_id once, which serves both that de-duplication
  and the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import quality_check
from ..operators.pivot import map_stage, pivot_stages
from ..schemas import CATALOG_ATTRS, PIVOT_KEYS, STAGE_COLUMNS, VALID_COMPLETE_PROCESS

ENRICHED_COLUMNS = ("client_id", "name", "age", "state", "email", "app", "stage",
                    "register_date", "complete_process", "quality_check")
STAGE_DATE_COLUMNS = PIVOT_KEYS + STAGE_COLUMNS


def with_quality(funnel: DataFrame) -> DataFrame:
    """P5: ``Passed`` when the id has 5 characters and the flag is 0/1."""
    return funnel.withColumn("quality_check", quality_check())


def enrich(funnel: DataFrame, catalog: DataFrame) -> DataFrame:
    """Funnel rows with quality flag, inner-joined to the catalog.

    Funnel rows without a catalog row and catalog rows without funnel
    rows drop out. The planner broadcasts the catalog only when its
    measured size is under the broadcast threshold; otherwise both sides
    shuffle on client_id (AQE splits a skewed client's partition)."""
    f = with_quality(funnel.select("client_id", "app", "stage", "register_date", "complete_process"))
    c = catalog.select("client_id", *CATALOG_ATTRS)
    return f.join(c, "client_id", "inner").select(*ENRICHED_COLUMNS)


def stage_dates_from_enriched(enriched: DataFrame) -> DataFrame:
    """A1 in the source order: map labels, pivot by the 7 client columns."""
    rows = map_stage(enriched.select(*PIVOT_KEYS, "stage", "register_date"))
    return pivot_stages(rows, PIVOT_KEYS).select(*STAGE_DATE_COLUMNS)


def client_stage_dates(funnel: DataFrame, catalog: DataFrame) -> DataFrame:
    """A1 over J1, pivot-first (same rows as ``stage_dates_from_enriched``)."""
    rows = map_stage(funnel.select("client_id", "complete_process", "app", "stage", "register_date"))
    dates = pivot_stages(rows, ["client_id", "complete_process", "app"])
    # Hash-partitioning on client_id satisfies the de-duplication's clustering
    # on all five columns, so the catalog is shuffled once, for both.
    cat = catalog.select("client_id", *CATALOG_ATTRS).repartition("client_id").dropDuplicates()
    return dates.join(cat, "client_id", "inner").select(*STAGE_DATE_COLUMNS)


def client_stage_dates_latest(funnel: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per-client table keyed by client_id alone (incremental runs).

    complete_process and app become aggregates instead of group keys, so a
    client whose later stage rows carry a new flag does not split into two
    rows; the catalog must hold one row per client_id. The flag is the largest
    valid one (an invalid code counts only if there is no valid one). The app
    is that of the earliest stage row that names one (rows without a date
    last, then the smallest name)."""
    rows = map_stage(funnel.select("client_id", "complete_process", "app", "stage", "register_date"))
    flag = F.col("complete_process")
    flag = F.coalesce(F.max(F.when(flag.isin(*VALID_COMPLETE_PROCESS), flag)), F.max(flag))
    first = F.struct(F.col("register_date").isNull(), F.col("register_date"), F.col("app").alias("app"))
    app = F.min(F.when(F.col("app").isNotNull(), first))["app"]
    dates = pivot_stages(rows, ["client_id"], extra=[flag.alias("complete_process"), app.alias("app")])
    cat = catalog.select("client_id", *CATALOG_ATTRS)
    return dates.join(cat, "client_id", "inner").select(*STAGE_DATE_COLUMNS)
