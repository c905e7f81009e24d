"""One incremental run landing -> bronze -> silver -> gold.

``run_batch(spark, layers, load_ts)`` is safe to re-run and is what a
scheduler (or the landing stream in ``stagewise.streaming``) calls per
drop. Two modes:

* ``change='strict'`` reproduces the source system: silver funnel and
  gold clients_funnel are insert-only, the catalog and the pivot are
  updated only when a ``<>`` test is true (NULL -> value is no change),
  and the pivot is rebuilt from the whole gold clients_funnel grouped by
  the seven client columns.
* ``change='null_safe'`` (default) is incremental and converges: every layer
  processes the keys of the drop that is being loaded, whatever its load stamp,
  so stamps may repeat or go back. Updates use a null-safe change test on the
  non-key columns (load timestamps are never compared), so rows that are already
  there stay as they are and running a drop again repairs a run that failed
  part-way. Only the drop's clients are re-pivoted, keyed by client_id alone
  (flag and app as aggregates), and only their buckets are read.
  Loading batch 1 then batch 2 gives the same per-client table as one load of
  the latest row per key.

A run reads each landing file once: ``staged_drop`` writes its text and typed values
to the shared scratch folder, split by bucket, and bronze, silver, gold and the
rejects are all made from that copy, so a file that lands meanwhile waits for the next run.

Rows with a NULL key match nothing, so MERGE inserts them again on every run of
their drop; ``null_keys='drop'`` leaves them out. ``dedupe=True`` keeps one row
of a drop's repeated keys, on which a MERGE otherwise fails.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.exprs import timestamp_value
from ..functions.parse import conform, typed
from ..operators.merge import Insert, Update, changed_condition, dedupe_latest, merge
from ..schemas import (
    CATALOG_ATTRS,
    CLIENTS_BRONZE_KEYS,
    CLIENTS_CONFORM,
    CLIENTS_FILE,
    CLIENTS_SOURCE_COLUMNS,
    FUNNEL_BRONZE_KEYS,
    FUNNEL_CONFORM,
    FUNNEL_FILE,
    FUNNEL_SOURCE_COLUMNS,
    GOLD_CLIENTS_FUNNEL,
    GOLD_PIVOT,
    LOAD_TS_COLUMN,
    SILVER_CATALOG,
    SILVER_FUNNEL,
    STAGE_COLUMNS,
)
from ..sources.landing import read_landing, with_load_ts
from ..session import drop_materialized, materialize
from ..sources.tables import (
    BUCKET, BUCKETS, bucket_expr, create_or_merge, ensure_table, merge_into, read_table, touched_buckets,
)
from . import gold
from .report_state import ReportState

FUNNEL_KEYS = ["client_id", "stage"]
#: Landing file -> its columns, bronze keys and silver names and types.
FILES = {
    FUNNEL_FILE: (FUNNEL_SOURCE_COLUMNS, FUNNEL_BRONZE_KEYS, FUNNEL_CONFORM),
    CLIENTS_FILE: (CLIENTS_SOURCE_COLUMNS, CLIENTS_BRONZE_KEYS, CLIENTS_CONFORM),
}
PV_COMPARED = ["name", "email", "age", "state", "complete_process", *STAGE_COLUMNS]
MALFORMED = "__malformed_line"


@dataclass(frozen=True)
class Layers:
    """Root folders of the four layers (shared storage on a cluster).

    ``buckets``: every table is split by its client id into this many hash
    buckets, and a load reads and rewrites only those of its clients. It belongs
    to the tables: keep it for as long as they live, and size it so that a bucket
    is a few hundred MB. ``reports``: root of the stored report sums (``report_state``),
    which runs in ``null_safe`` mode then keep up; None keeps none."""

    landing: str
    bronze: str
    silver: str
    gold: str
    buckets: int = BUCKETS
    reports: str | None = None

    def table(self, layer: str, name: str) -> str:
        return f"{getattr(self, layer).rstrip('/')}/{name}"


@dataclass(frozen=True)
class StagedFile:
    """The written copy of a landing file: ``raw`` and ``typed`` (structs), MALFORMED and the bucket; and which buckets occur."""

    rows: DataFrame
    buckets: list[int]


Drop = dict[str, StagedFile]


@contextmanager
def staged_drop(spark: SparkSession, layers: Layers, given: Drop | None = None) -> Iterator[Drop]:
    """The landing drop, each file parsed once and written; removed at the end.
    ``given`` passes an already staged drop through, which stays its owner's."""
    if given is not None:
        yield given
        return
    drop: Drop = {}
    try:
        for name, (cols, keys, spec) in FILES.items():
            rows = read_landing(spark, layers.landing, name, cols, malformed=MALFORMED)
            raw = F.struct(*[F.col(c) for c in cols]).alias("raw")
            casts = F.struct(*[typed(rows, src, to).alias(dst) for src, (dst, to) in spec.items() if src in cols])
            bucket = bucket_expr([keys[0]], layers.buckets, cols).alias(BUCKET)
            staged = materialize(rows.select(raw, casts.alias("typed"), MALFORMED, bucket), "drop")
            drop[name] = StagedFile(staged, touched_buckets(staged))
        yield drop
    finally:
        for file in drop.values():
            drop_materialized(file.rows)


def drop_rows(drop: Drop, name: str, load_ts, dedupe: bool = False, view: str = "raw") -> DataFrame:
    """A staged file's ``raw`` (bronze) or ``typed`` (silver) rows, stamped. ``dedupe`` keeps of
    each key the row whose text is greatest by its columns in order; rows with a NULL key all stay."""
    cols, keys, spec = FILES[name]
    rows = drop[name].rows
    if dedupe:
        wide = rows.select("raw.*", F.struct("raw", "typed").alias("__both"))
        rows = dedupe_latest(wide, keys).select("__both.*")
    stamp = LOAD_TS_COLUMN if view == "raw" else spec[LOAD_TS_COLUMN][0]
    return with_load_ts(rows.select(f"{view}.*", *([] if dedupe else [BUCKET])), stamp, load_ts)


def load_bronze(spark: SparkSession, layers: Layers, load_ts, dedupe: bool = False, null_keys: str = "insert",
                drop: Drop | None = None) -> None:
    """Landing drop -> bronze, create-or-merge (update-all / insert-all)."""
    with staged_drop(spark, layers, drop) as staged:
        for name, (_, keys, _) in FILES.items():
            create_or_merge(spark, layers.table("bronze", name), drop_rows(staged, name, load_ts, dedupe), list(keys),
                            buckets=layers.buckets, bucket_by=[keys[0]], null_keys=null_keys, touched=staged[name].buckets)


def _conformed(spark: SparkSession, layers: Layers, name: str, load_ts, change: str, dedupe: bool, drop: Drop) -> DataFrame:
    """Typed rows for silver: all of bronze in strict mode, else the drop's, which
    are what the update-all MERGE has just put into bronze."""
    if change == "strict":
        return conform(read_table(spark, layers.table("bronze", name)), FILES[name][2])
    return drop_rows(drop, name, load_ts, dedupe, "typed")


def load_silver(spark: SparkSession, layers: Layers, load_ts, change: str = "null_safe",
                dedupe: bool = False, null_keys: str = "insert", drop: Drop | None = None) -> None:
    """The drop's typed rows -> silver funnel and catalog."""
    if drop is None:
        with staged_drop(spark, layers) as staged:
            return load_silver(spark, layers, load_ts, change, dedupe, null_keys, staged)
    now = timestamp_value(load_ts)
    funnel_root, catalog_root = layers.table("silver", "users_funnel"), layers.table("silver", "catalog")
    ensure_table(spark, funnel_root, SILVER_FUNNEL)
    ensure_table(spark, catalog_root, SILVER_CATALOG)
    layout = {"buckets": layers.buckets, "bucket_by": ["client_id"], "null_keys": null_keys}
    # in strict mode the source is all of bronze
    in_drop = {name: None if change == "strict" else drop[name].buckets for name in FILES}

    values = {c: F.col(f"s.{c}") for c in ["client_id", "app", "stage", "register_date", "complete_process"]}
    values["ingestion_date"] = now
    upd = None
    if change != "strict":
        cmp = ["app", "register_date", "complete_process"]
        upd = Update({**{c: F.col(f"s.{c}") for c in cmp}, "ingestion_date": now},
                     changed_condition(cmp, change))
    merge_into(spark, funnel_root, _conformed(spark, layers, FUNNEL_FILE, load_ts, change, dedupe, drop), FUNNEL_KEYS, upd,
               Insert(values), schema=SILVER_FUNNEL, touched=in_drop[FUNNEL_FILE], **layout)

    attrs = list(CATALOG_ATTRS)
    merge_into(
        spark, catalog_root, _conformed(spark, layers, CLIENTS_FILE, load_ts, change, dedupe, drop), ["client_id"],
        Update({**{c: F.col(f"s.{c}") for c in attrs}, "ingestion_date": F.col("s.ingestion_date"),
                "update_date": now}, changed_condition(attrs, change)),
        Insert({**{c: F.col(f"s.{c}") for c in ["client_id", *attrs, "ingestion_date"]}, "update_date": "Null"}),
        schema=SILVER_CATALOG, touched=in_drop[CLIENTS_FILE], **layout,
    )


def load_gold(spark: SparkSession, layers: Layers, load_ts, change: str = "null_safe", drop: Drop | None = None) -> None:
    """Silver -> gold clients_funnel (J1 + flag) and the per-client pivot."""
    if drop is None and change != "strict":
        with staged_drop(spark, layers) as staged:
            return load_gold(spark, layers, load_ts, change, staged)
    now = timestamp_value(load_ts)
    cf_root, pv_root = layers.table("gold", "clients_funnel"), layers.table("gold", "pv_clients_stage")
    ensure_table(spark, cf_root, GOLD_CLIENTS_FUNNEL)
    ensure_table(spark, pv_root, GOLD_PIVOT)
    layout = {"buckets": layers.buckets, "bucket_by": ["client_id"]}
    cf_values = {c: F.col(f"s.{c}") for c in gold.ENRICHED_COLUMNS}
    cf_values["ingestion_date"] = now
    pv_insert = Insert({**{c: F.col(f"s.{c}") for c in gold.STAGE_DATE_COLUMNS}, "ingestion_time": now})
    pv_set = {**{c: F.col(f"s.{c}") for c in PV_COMPARED}, "update_date": now}

    def silver(name: str, schema: StructType, buckets=None) -> DataFrame:
        return read_table(spark, layers.table("silver", name), schema, buckets)

    if change == "strict":
        enriched = gold.enrich(silver("users_funnel", SILVER_FUNNEL), silver("catalog", SILVER_CATALOG))
        merge_into(spark, cf_root, enriched, FUNNEL_KEYS, None, Insert(cf_values), schema=GOLD_CLIENTS_FUNNEL, **layout)
        source = gold.stage_dates_from_enriched(read_table(spark, cf_root, GOLD_CLIENTS_FUNNEL))
        merge_into(spark, pv_root, source, ["client_id"],
                   Update(pv_set, changed_condition(PV_COMPARED, "strict")), pv_insert, schema=GOLD_PIVOT, **layout)
        return

    b = sorted({k for name in FILES for k in drop[name].buckets})
    layout["touched"] = b
    ids = [drop[name].rows.select("typed.client_id", BUCKET) for name in FILES]
    touched = materialize(ids[0].unionByName(ids[1]).dropna().distinct(), "touched")
    try:
        f_t = silver("users_funnel", SILVER_FUNNEL, b).join(touched, "client_id", "left_semi")
        catalog = silver("catalog", SILVER_CATALOG, b)
        cf_cmp = [c for c in gold.ENRICHED_COLUMNS if c not in FUNNEL_KEYS]
        merge_into(spark, cf_root, gold.enrich(f_t, catalog), FUNNEL_KEYS,
                   Update({**{c: F.col(f"s.{c}") for c in cf_cmp}, "ingestion_date": now},
                          changed_condition(cf_cmp, change)),
                   Insert(cf_values), schema=GOLD_CLIENTS_FUNNEL, **layout)
        # The merge's ambiguity check guarantees one source row per client_id.
        dates, pv_update = gold.client_stage_dates_latest(f_t, catalog), Update(pv_set, changed_condition(PV_COMPARED, change))
        if layers.reports is None:
            merge_into(spark, pv_root, dates, ["client_id"], pv_update, pv_insert, schema=GOLD_PIVOT, **layout)
        else:
            state = report_state(spark, layers)
            state.start()
            old = read_table(spark, pv_root, GOLD_PIVOT, b).join(touched, "client_id", "left_semi")
            state.apply(old, merge(old, dates, ["client_id"], pv_update, pv_insert))
    finally:
        drop_materialized(touched)


def report_state(spark: SparkSession, layers: Layers) -> ReportState:
    """The stored sums of the layers' per-client table."""
    return ReportState(spark, layers.reports, layers.table("gold", "pv_clients_stage"), layers.buckets)


def load_rejects(spark: SparkSession, layers: Layers, drop: Drop | None = None) -> DataFrame:
    """Per file and typed column of the landing drop, how many values are
    there as text but don't parse: ``(file, column, rows, rejected)``. The row
    of column ``(line)`` counts lines with too few or too many fields. A few rows,
    counted now and written, so they stay those of this drop."""
    with staged_drop(spark, layers, drop) as staged:
        parts = []
        for name, (cols, _, spec) in FILES.items():
            bad = {to: F.col(f"raw.{src}").isNotNull() & F.col(f"typed.{to}").isNull()
                   for src, (to, kind) in spec.items() if src in cols and kind != "string"}
            bad["(line)"] = F.col(MALFORMED).isNotNull()
            counts = staged[name].rows.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.when(c, 1)).alias(to) for to, c in bad.items()])
            each = F.explode(F.array(*[F.struct(F.lit(to).alias("column"), F.col(f"`{to}`").alias("rejected")) for to in bad]))
            parts.append(counts.select("rows", each.alias("x")).select(F.lit(name).alias("file"), "x.column", "rows", "x.rejected"))
        return materialize(parts[0].unionByName(parts[1]), "rejects")


def run_batch(spark: SparkSession, layers: Layers, load_ts: str | _dt.datetime, change: str = "null_safe",
              dedupe: bool = False, null_keys: str = "insert") -> DataFrame:
    """One scheduled run over the current landing drop (X6); returns its rejects (``load_rejects``)."""
    with staged_drop(spark, layers) as drop:
        load_bronze(spark, layers, load_ts, dedupe, null_keys, drop)
        load_silver(spark, layers, load_ts, change, dedupe, null_keys, drop)
        load_gold(spark, layers, load_ts, change, drop)
        return load_rejects(spark, layers, drop)
