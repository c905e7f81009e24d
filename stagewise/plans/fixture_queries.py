"""Every operator of the library run over the fixture views of the
driver's tables: one function per query key, each ``(spark, sf_dir) ->
DataFrame``. These are what ``__spark_entry__.queries()`` registers and
what the oracle SQL in ``oracle_sql.py`` recomputes independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import age_group as age_group_expr
from ..functions.exprs import timestamp_value
from ..functions.parse import conform
from ..functions.parse import parse_date as parse_date_expr
from ..functions.parse import parse_timestamp as parse_timestamp_expr
from ..functions.quality import reject_counts
from ..operators import funnel as fn
from ..operators import reports as rp
from ..operators.merge import Insert, Update, changed_condition, merge, upsert_all
from ..operators.pivot import map_stage as map_stage_op
from ..schemas import (
    CLIENTS_CONFORM,
    CLIENTS_FILE,
    FUNNEL_BRONZE_KEYS,
    FUNNEL_CONFORM,
    FUNNEL_FILE,
    FUNNEL_SOURCE_COLUMNS,
    LOAD_TS_COLUMN,
    SILVER_CATALOG,
    SILVER_FUNNEL,
    STAGE_COLUMNS,
)
from ..session import scratch_dir
from ..sources import fixtures as fx
from ..sources.landing import read_landing, with_load_ts, write_landing
from ..sources.tables import create_or_merge, ensure_table, merge_into, read_table
from ..streaming.landing_stream import landing_stream
from . import gold
from .incremental import Layers, load_rejects, run_batch

TS1 = "2024-01-01 00:00:00"
TS2 = "2024-02-01 00:00:00"
TS3 = "2024-03-01 00:00:00"


@fx.memo_view
def stage_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold per-client table from the fixture views (pivot-first plan)."""
    return gold.client_stage_dates(fx.funnel_events(spark, sf_dir), fx.clients(spark, sf_dir))


# --- J1, P5, P6, P7, A1 -------------------------------------------------

def funnel_enriched(spark, sf_dir):
    return gold.enrich(fx.funnel_events(spark, sf_dir), fx.clients(spark, sf_dir))


def quality_check(spark, sf_dir):
    return gold.with_quality(fx.funnel_events(spark, sf_dir))


def map_stage(spark, sf_dir):
    return map_stage_op(fx.funnel_events(spark, sf_dir))


def age_group(spark, sf_dir):
    return fx.clients(spark, sf_dir).withColumn("Age_group", age_group_expr("age"))


def pivot_stages(spark, sf_dir):
    return stage_dates(spark, sf_dir)


def pivot_stages_reference_order(spark, sf_dir):
    return gold.stage_dates_from_enriched(funnel_enriched(spark, sf_dir))


# --- A2-A9 ----------------------------------------------------------------

def finished_all(spark, sf_dir):
    return rp.finished_all(stage_dates(spark, sf_dir))


def didnt_finish_all(spark, sf_dir):
    return rp.didnt_finish_all(stage_dates(spark, sf_dir))


def total_time(spark, sf_dir):
    return rp.total_time(stage_dates(spark, sf_dir))


def abandonment(spark, sf_dir):
    return fn.abandonment(stage_dates(spark, sf_dir))


def state_completed(spark, sf_dir):
    return rp.state_completed(stage_dates(spark, sf_dir))


def state_open(spark, sf_dir):
    return rp.state_open(stage_dates(spark, sf_dir))


def confirmed_not_complete(spark, sf_dir):
    return rp.confirmed_not_complete(stage_dates(spark, sf_dir))


def avg_days_state(spark, sf_dir):
    return rp.avg_days_state(stage_dates(spark, sf_dir))


def state_clients(spark, sf_dir):
    return rp.state_clients(stage_dates(spark, sf_dir))


# --- A10-A16, X1-X4 -------------------------------------------------------

def funnel_global(spark, sf_dir):
    return fn.reached(stage_dates(spark, sf_dir))


def funnel_state(spark, sf_dir):
    return fn.reached(stage_dates(spark, sf_dir), ["state"])


def funnel_state_age(spark, sf_dir):
    return fn.funnel_state_age(stage_dates(spark, sf_dir))


def funnel_unpivot(spark, sf_dir):
    return fn.unpivot_counts(fn.reached(stage_dates(spark, sf_dir), ["state"]), ["state"])


def conversion_global(spark, sf_dir):
    return fn.conversion_global(stage_dates(spark, sf_dir))


def conversion_per_state(spark, sf_dir):
    return fn.conversion_per_state(stage_dates(spark, sf_dir))


def conversion_by_age(spark, sf_dir):
    return fn.conversion_by_age(stage_dates(spark, sf_dir))


def conversion_tcd_state(spark, sf_dir):
    return fn.conversion_to_stage(stage_dates(spark, sf_dir), "TCD")


def dropoff(spark, sf_dir):
    return fn.dropoff(stage_dates(spark, sf_dir))


def avg_days_per_stage(spark, sf_dir):
    return fn.avg_days_per_stage(stage_dates(spark, sf_dir))


def top_abandoned_stage(spark, sf_dir):
    return fn.top_abandoned_stage(stage_dates(spark, sf_dir))


def funnel_rollup_state(spark, sf_dir):
    """A11 derived from the one-scan rollup (sum of the state x age counts)."""
    return fn.funnel_rollup(stage_dates(spark, sf_dir))["funnel_state"]


def funnel_rollup_conversion_by_age(spark, sf_dir):
    """A16 from the one-scan rollup."""
    return fn.funnel_rollup(stage_dates(spark, sf_dir))["conversion_by_age"]


QUERIES = {
    "funnel_rollup_state": funnel_rollup_state,
    "funnel_rollup_conversion_by_age": funnel_rollup_conversion_by_age,
    "funnel_enriched": funnel_enriched,
    "quality_check": quality_check,
    "map_stage": map_stage,
    "age_group": age_group,
    "pivot_stages": pivot_stages,
    "pivot_stages_reference_order": pivot_stages_reference_order,
    "finished_all": finished_all,
    "didnt_finish_all": didnt_finish_all,
    "total_time": total_time,
    "abandonment": abandonment,
    "state_completed": state_completed,
    "state_open": state_open,
    "confirmed_not_complete": confirmed_not_complete,
    "avg_days_state": avg_days_state,
    "state_clients": state_clients,
    "funnel_global": funnel_global,
    "funnel_state": funnel_state,
    "funnel_state_age": funnel_state_age,
    "funnel_unpivot": funnel_unpivot,
    "conversion_global": conversion_global,
    "conversion_per_state": conversion_per_state,
    "conversion_by_age": conversion_by_age,
    "conversion_tcd_state": conversion_tcd_state,
    "dropoff": dropoff,
    "avg_days_per_stage": avg_days_per_stage,
    "top_abandoned_stage": top_abandoned_stage,
}


# --- I1, I2, P1-P3 --------------------------------------------------------

def _funnel_text(spark, sf_dir, slash_dates: bool = False) -> DataFrame:
    """The funnel as a landing file would carry it: Spanish headers, text."""
    ev = fx.funnel_events(spark, sf_dir)
    d = F.col("register_date")
    date_txt = F.date_format(d, "yyyy-MM-dd")
    if slash_dates:
        date_txt = F.when(F.dayofmonth(d) % 2 == 0, F.date_format(d, "yyyy/MM/dd")).otherwise(date_txt)
    return ev.select(
        F.col("client_id").alias("ID_cliente"), F.col("app").alias("App"), "stage",
        date_txt.alias("date"), F.col("complete_process").cast("string").alias("Proceso_completo"),
    )


def landing_csv(spark, sf_dir):
    """Drop the funnel as a header CSV in a fresh shared folder, read it back."""
    root = scratch_dir(spark, "landing")
    write_landing(_funnel_text(spark, sf_dir), root, FUNNEL_FILE)
    return read_landing(spark, root, FUNNEL_FILE, FUNNEL_SOURCE_COLUMNS)


def load_stamp(spark, sf_dir):
    """Stamp rows with one literal load time."""
    return with_load_ts(_funnel_text(spark, sf_dir), LOAD_TS_COLUMN, TS1)


def conform_funnel(spark, sf_dir):
    """P1 + P2: Spanish text columns (ISO and slash dates) -> typed silver rows."""
    bronze = with_load_ts(_funnel_text(spark, sf_dir, slash_dates=True), LOAD_TS_COLUMN, TS1)
    return conform(bronze, FUNNEL_CONFORM)


def conform_clients(spark, sf_dir):
    """Catalog text -> typed; a missing age arrives as junk text -> NULL."""
    c = fx.clients(spark, sf_dir)
    bronze = c.select(
        F.col("client_id").alias("ID_cliente"), F.col("name").alias("Nombre"),
        F.col("email").alias("Correo"),
        # every fifth age is decimal text
        F.coalesce(F.when(F.col("age") % 5 == 0, F.concat(F.col("age").cast("string"), F.lit(".0")))
                   .otherwise(F.col("age").cast("string")), F.lit("n/a")).alias("Edad"),
        F.col("state").alias("Estado"),
    )
    return conform(with_load_ts(bronze, LOAD_TS_COLUMN, TS1), CLIENTS_CONFORM)


def _order_dates_text(spark, sf_dir, iso: str, slash: str) -> DataFrame:
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    r = F.col("o_orderkey") % 3
    txt = (F.when(r == 0, F.date_format("o_orderdate", iso))
           .when(r == 1, F.date_format("o_orderdate", slash))
           .otherwise(F.lit("not-a-date")))
    return o.select("o_orderkey", txt.alias("txt"))


def parse_date(spark, sf_dir):
    """ISO, slash and junk date text -> DATE or NULL."""
    df = _order_dates_text(spark, sf_dir, "yyyy-MM-dd", "yyyy/MM/dd")
    return df.select("o_orderkey", "txt", parse_date_expr("txt").alias("parsed"))


def parse_timestamp(spark, sf_dir):
    """ISO, slash and junk timestamp text -> TIMESTAMP or NULL."""
    df = _order_dates_text(spark, sf_dir, "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss")
    return df.select("o_orderkey", "txt", parse_timestamp_expr("txt").alias("parsed"))


def parse_rejects(spark, sf_dir):
    """Count of values present as text but not parseable, per column."""
    bronze = _order_dates_text(spark, sf_dir, "yyyy-MM-dd", "yyyy/MM/dd").withColumnRenamed("txt", "date")
    return reject_counts(bronze, {"date": ("register_date", "date")})


# --- M1-M6 ----------------------------------------------------------------

FUNNEL_KEYS = ["client_id", "stage"]
INCREMENTAL_BUCKETS = 8
PV_COMPARED = ["name", "email", "age", "state", "complete_process", *STAGE_COLUMNS]


def _b(spark, sf_dir, batch, ts=None):
    df = fx.funnel_batch(spark, sf_dir, batch)
    return df if ts is None else df.withColumn("ingestion_date", timestamp_value(ts))


def merge_upsert_all(spark, sf_dir):
    """M1: batch 2 upserted over batch 1 (every column replaced on match)."""
    return upsert_all(_b(spark, sf_dir, 1, TS1), _b(spark, sf_dir, 2, TS2), FUNNEL_KEYS)


def merge_insert_only(spark, sf_dir):
    """M2: batch 2 inserted where (client_id, stage) is new; ingestion = now."""
    values = {c: f"s.{c}" for c in ["client_id", "app", "stage", "register_date", "complete_process"]}
    values["ingestion_date"] = timestamp_value(TS2)
    return merge(_b(spark, sf_dir, 1, TS1), _b(spark, sf_dir, 2), FUNNEL_KEYS, None, Insert(values))


def _catalog_merge(spark, sf_dir, mode):
    target = (fx.clients_batch(spark, sf_dir, 1)
              .withColumn("ingestion_date", timestamp_value(TS1))
              .withColumn("update_date", F.lit(None).cast("timestamp")))
    source = fx.clients_batch(spark, sf_dir, 2).withColumn("ingestion_date", timestamp_value(TS2))
    attrs = ["name", "email", "age", "state"]
    upd = Update(
        set={**{c: f"s.{c}" for c in attrs}, "ingestion_date": "s.ingestion_date",
             "update_date": timestamp_value(TS3)},
        condition=changed_condition(attrs, mode),
    )
    ins = Insert({**{c: f"s.{c}" for c in ["client_id", *attrs, "ingestion_date"]}, "update_date": "Null"})
    return merge(target.select(*SILVER_CATALOG.fieldNames()), source, ["client_id"], upd, ins)


def merge_scd1_catalog(spark, sf_dir):
    """M3 as the source system does it: strict ``<>`` change test."""
    return _catalog_merge(spark, sf_dir, "strict")


def merge_scd1_catalog_null_safe(spark, sf_dir):
    """M3 with the null-safe change test (a filled-in age is a change)."""
    return _catalog_merge(spark, sf_dir, "null_safe")


def _enriched_batch(spark, sf_dir, batch):
    return gold.enrich(fx.funnel_batch(spark, sf_dir, batch), fx.clients(spark, sf_dir))


def merge_clients_funnel(spark, sf_dir):
    """M4: enriched batch 2 inserted into the enriched batch 1 (insert-only)."""
    target = _enriched_batch(spark, sf_dir, 1).withColumn("ingestion_date", timestamp_value(TS1))
    values = {c: f"s.{c}" for c in gold.ENRICHED_COLUMNS}
    values["ingestion_date"] = timestamp_value(TS2)
    return merge(target, _enriched_batch(spark, sf_dir, 2), FUNNEL_KEYS, None, Insert(values))


def _pivot_merge(spark, sf_dir, mode):
    target = (gold.stage_dates_from_enriched(_enriched_batch(spark, sf_dir, 1))
              .withColumn("ingestion_time", timestamp_value(TS1))
              .withColumn("update_date", F.lit(None).cast("timestamp")))
    source = gold.stage_dates_from_enriched(merge_clients_funnel(spark, sf_dir))
    upd = Update(
        set={**{c: F.col(f"s.{c}") for c in PV_COMPARED}, "update_date": timestamp_value(TS3)},
        condition=changed_condition(PV_COMPARED, mode),
    )
    ins = Insert({**{c: F.col(f"s.{c}") for c in gold.STAGE_DATE_COLUMNS}, "ingestion_time": timestamp_value(TS2)})
    return merge(target, source, ["client_id"], upd, ins)


def merge_pivot_scd1(spark, sf_dir):
    """M5 as the source system does it: strict ``!=`` on 11 columns, so a
    stage date appearing where there was NULL is not an update."""
    return _pivot_merge(spark, sf_dir, "strict")


def merge_pivot_scd1_null_safe(spark, sf_dir):
    """M5 with the null-safe change test."""
    return _pivot_merge(spark, sf_dir, "null_safe")


def create_or_merge_two_batches(spark, sf_dir):
    """Two landing drops -> bronze table, created by the first load
    and MERGEd (update-all / insert-all) by the second."""
    root = scratch_dir(spark, "bronze")
    for batch, ts in ((1, TS1), (2, TS2)):
        landing = scratch_dir(spark, f"landing{batch}")
        drop = fx.funnel_batch(spark, sf_dir, batch).select(
            F.col("client_id").alias("ID_cliente"), F.col("app").alias("App"), "stage",
            F.col("register_date").alias("date"), F.col("complete_process").alias("Proceso_completo"))
        write_landing(drop, landing, FUNNEL_FILE)
        src = with_load_ts(read_landing(spark, landing, FUNNEL_FILE, FUNNEL_SOURCE_COLUMNS), LOAD_TS_COLUMN, ts)
        create_or_merge(spark, f"{root}/{FUNNEL_FILE}", src, list(FUNNEL_BRONZE_KEYS))
    return read_table(spark, f"{root}/{FUNNEL_FILE}")


def empty_table_first_merge(spark, sf_dir):
    """I7 + M2 in the source order: create the empty typed silver table
    (create-if-absent, twice), then the first insert-only MERGE into it."""
    root = f"{scratch_dir(spark, 'silver')}/users_funnel"
    ensure_table(spark, root, SILVER_FUNNEL)
    ensure_table(spark, root, SILVER_FUNNEL)
    values = {c: f"s.{c}" for c in ["client_id", "app", "stage", "register_date", "complete_process"]}
    values["ingestion_date"] = timestamp_value(TS1)
    merge_into(spark, root, fx.funnel_events(spark, sf_dir), FUNNEL_KEYS, None, Insert(values),
               schema=SILVER_FUNNEL)
    return read_table(spark, root, schema=SILVER_FUNNEL)


QUERIES.update({
    "empty_table_first_merge": empty_table_first_merge,
    "landing_csv": landing_csv,
    "load_stamp": load_stamp,
    "conform_funnel": conform_funnel,
    "conform_clients": conform_clients,
    "parse_date": parse_date,
    "parse_timestamp": parse_timestamp,
    "parse_rejects": parse_rejects,
    "merge_upsert_all": merge_upsert_all,
    "merge_insert_only": merge_insert_only,
    "merge_scd1_catalog": merge_scd1_catalog,
    "merge_scd1_catalog_null_safe": merge_scd1_catalog_null_safe,
    "merge_clients_funnel": merge_clients_funnel,
    "merge_pivot_scd1": merge_pivot_scd1,
    "merge_pivot_scd1_null_safe": merge_pivot_scd1_null_safe,
    "create_or_merge": create_or_merge_two_batches,
})


# --- X6: incremental runs -------------------------------------------------

def _drop_batch(spark, sf_dir, batch, landing_root, catalog_changes=True):
    """Write one landing drop (funnel + catalog, Spanish headers, text).
    Without ``catalog_changes`` every drop carries the same full catalog."""
    write_drop(fx.funnel_batch(spark, sf_dir, batch),
               fx.clients_batch(spark, sf_dir, batch) if catalog_changes else fx.clients(spark, sf_dir), landing_root)


def write_drop(funnel: DataFrame, catalog: DataFrame, landing_root: str) -> None:
    """Typed rows as the two landing files of a drop."""
    write_landing(funnel.select(
        F.col("client_id").alias("ID_cliente"), F.col("app").alias("App"), "stage",
        F.col("register_date").alias("date"), F.col("complete_process").alias("Proceso_completo")), landing_root, FUNNEL_FILE)
    write_landing(catalog.select(
        F.col("client_id").alias("ID_cliente"), F.col("name").alias("Nombre"), F.col("email").alias("Correo"),
        F.col("age").alias("Edad"), F.col("state").alias("Estado")), landing_root, CLIENTS_FILE)


def run_two_batches(spark, sf_dir, change="null_safe", catalog_changes=True, buckets=INCREMENTAL_BUCKETS,
                    stamps=(TS1, TS2)) -> Layers:
    base = scratch_dir(spark, "layers")
    layers = None
    for batch, ts in zip((1, 2), stamps):
        layers = Layers(landing=f"{base}/landing{batch}", bronze=f"{base}/bronze",
                        silver=f"{base}/silver", gold=f"{base}/gold", buckets=buckets)
        _drop_batch(spark, sf_dir, batch, layers.landing, catalog_changes)
        run_batch(spark, layers, ts, change)
    return layers


def incremental_two_batches(spark, sf_dir):
    """Two scheduled runs (corrected mode); the per-client gold table
    without its load timestamps equals a one-shot load of the latest rows."""
    layers = run_two_batches(spark, sf_dir, "null_safe")
    return read_table(spark, layers.table("gold", "pv_clients_stage")).drop("ingestion_time", "update_date")


def incremental_two_batches_bucketed(spark, sf_dir):
    """X6 with finer hash buckets: same result whatever their number."""
    layers = run_two_batches(spark, sf_dir, "null_safe", buckets=4 * INCREMENTAL_BUCKETS)
    return read_table(spark, layers.table("gold", "pv_clients_stage")).drop("ingestion_time", "update_date")


def incremental_same_stamp(spark, sf_dir):
    """X6 with the same load stamp for both runs: stamps decide nothing."""
    layers = run_two_batches(spark, sf_dir, "null_safe", stamps=(TS1, TS1))
    return read_table(spark, layers.table("gold", "pv_clients_stage")).drop("ingestion_time", "update_date")


def landing_stream_two_drops(spark, sf_dir, buckets=INCREMENTAL_BUCKETS):
    """Two drops picked up by a file stream (one availableNow run per drop),
    each MERGEd into bronze in foreachBatch; same table as create_or_merge."""
    base = scratch_dir(spark, "stream")
    drops, bronze, ckpt = f"{base}/drops", f"{base}/bronze/{FUNNEL_FILE}", f"{base}/_checkpoint"
    stamps = {0: TS1, 1: TS2}
    for batch in (1, 2):
        drop = fx.funnel_batch(spark, sf_dir, batch).select(
            F.col("client_id").alias("ID_cliente"), F.col("app").alias("App"), "stage",
            F.col("register_date").cast("string").alias("date"),
            F.col("complete_process").cast("string").alias("Proceso_completo"))
        drop.write.mode("append").option("header", True).csv(drops)
        q = landing_stream(spark, drops, FUNNEL_SOURCE_COLUMNS, bronze, list(FUNNEL_BRONZE_KEYS), ckpt,
                           stamp=lambda i: stamps[i], buckets=buckets)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return read_table(spark, bronze)


def load_rejects_of_drop(spark, sf_dir):
    """The rejects of a drop with unreadable dates (every 13th of a month) and ages."""
    root = scratch_dir(spark, "rejects")
    date = F.when(F.dayofmonth("register_date") == 13, F.lit("not-a-date")).otherwise(F.col("register_date").cast("string"))
    write_landing(fx.funnel_events(spark, sf_dir).select(
        F.col("client_id").alias("ID_cliente"), F.col("app").alias("App"), "stage", date.alias("date"),
        F.col("complete_process").alias("Proceso_completo")), root, FUNNEL_FILE)
    write_landing(fx.clients(spark, sf_dir).select(
        F.col("client_id").alias("ID_cliente"), F.col("name").alias("Nombre"), F.col("email").alias("Correo"),
        F.coalesce(F.col("age").cast("string"), F.lit("n/a")).alias("Edad"), F.col("state").alias("Estado")),
        root, CLIENTS_FILE)
    return load_rejects(spark, Layers(root, root, root, root))


def top_open_states(spark, sf_dir):
    """O2 + O3: the five states with most open clients (ties by name)."""
    return rp.first_rows(rp.state_open(stage_dates(spark, sf_dir)), 5, F.col("Total_per_country").desc(), "state")


def merge_text_condition(spark, sf_dir):
    """M1/M3 with the merge condition as SQL text: only later dates match."""
    return merge(_b(spark, sf_dir, 1), _b(spark, sf_dir, 2),
                 "t.client_id = s.client_id AND t.stage = s.stage AND s.register_date > t.register_date",
                 Update({"register_date": "s.register_date"}), Insert())


QUERIES.update({
    "load_rejects": load_rejects_of_drop,
    "top_open_states": top_open_states,
    "merge_text_condition": merge_text_condition,
    "incremental_two_batches": incremental_two_batches,
    "incremental_two_batches_bucketed": incremental_two_batches_bucketed,
    "incremental_same_stamp": incremental_same_stamp,
    "landing_stream": landing_stream_two_drops,
})
