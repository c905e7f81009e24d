"""Funnel-shaped inputs derived from the driver's TPC-H-style tables.

The reference ships no data, so the funnel and the client catalog are
derived from ``orders`` and ``customer``/``nation`` by fixed rules
(documented in FIXTURES.md). Everything is a lazy DataFrame over the
parquet scans, so Catalyst prunes columns and pushes the filters down,
and the work grows with the tables.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import STAGES

# Fixed values of the derivation rules (FIXTURES.md section 3).
ID_OFFSET = 9950
UNKNOWN_STAGE_LABEL = "Otro"
BATCH_SPLIT = "1996-01-01 00:00:00"


# Columns of the driver tables read here (a known schema skips the
# footer-reading job of schema inference; only these columns are scanned).
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
}


def memo_view(fn):
    """Build a fixture view's plan once per (application, session, folder,
    args), like registering a temp view once; every use still executes it.
    Plans are immutable, so sharing the DataFrame object is safe."""
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str, *args, **kw):
        key = (spark.sparkContext.applicationId, id(spark), sf_dir, args, tuple(sorted(kw.items())))
        if key not in cache:
            cache[key] = fn(spark, sf_dir, *args, **kw)
        return cache[key]

    return wrapper


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if name in SCHEMAS:
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def _client_id(custkey: Column) -> Column:
    return (custkey + ID_OFFSET).cast("string")


@memo_view
def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client catalog: one row per kept customer (client_id is unique).

    Every 17th customer is missing (orphans for the inner join), every
    23rd has a NULL age. ``nation`` is a 25-row dimension; the planner
    broadcasts it by its measured size.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    return (
        c.filter(k % 17 != 0)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .select(
            _client_id(k).alias("client_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("c"), k.cast("string"), F.lit("@example.com")).alias("email"),
            F.when(k % 23 == 0, F.lit(None)).otherwise(16 + (k * 7) % 50).cast("int").alias("age"),
            F.col("n_name").alias("state"),
        )
    )


def _stage_label(orderkey: Column) -> Column:
    r = orderkey % 7
    out = None
    for i, s in enumerate(STAGES):
        out = F.when(r == i, F.lit(s.label)) if out is None else out.when(r == i, F.lit(s.label))
    return out.otherwise(F.lit(UNKNOWN_STAGE_LABEL))


@memo_view
def funnel_events(spark: SparkSession, sf_dir: str, with_ts: bool = False, with_key: bool = False) -> DataFrame:
    """Stage events: client_id, app, stage (source label), register_date,
    complete_process. A client reaches at most stage ``custkey % 6``;
    ``Otro`` is an unknown label; complete_process 2 is invalid.
    ``with_ts`` keeps ``o_orderdate`` and ``with_key`` the order key for batch splitting."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    cols = [
        _client_id(ck).alias("client_id"),
        F.when(ck % 2 == 0, F.lit("ios")).otherwise(F.lit("android")).alias("app"),
        _stage_label(ok).alias("stage"),
        F.col("o_orderdate").cast("date").alias("register_date"),
        F.when(ck % 31 == 0, F.lit(2))
        .when((ck % 6 == 5) & (ck % 5 != 0), F.lit(1))
        .otherwise(F.lit(0))
        .cast("int")
        .alias("complete_process"),
    ]
    if with_ts:
        cols.append(F.col("o_orderdate"))
    if with_key:
        cols.append(ok)
    return o.filter((ok % 7 == 6) | (ok % 7 <= ck % 6)).select(*cols)


@memo_view
def funnel_batch(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """Batch 1 = orders before 1996, batch 2 = the rest, each reduced to
    one row per (client_id, stage) with the earliest register_date.

    app and complete_process are functions of the customer, so grouping
    by them as well keeps one row per key. Partial aggregation collapses
    a hot key before the shuffle.
    """
    ev = funnel_events(spark, sf_dir, with_ts=True)
    split = F.lit(BATCH_SPLIT).cast(ev.schema["o_orderdate"].dataType)
    ts = F.col("o_orderdate")
    ev = ev.filter(ts < split) if batch == 1 else ev.filter(ts >= split)
    return ev.groupBy("client_id", "app", "stage", "complete_process").agg(
        F.min("register_date").alias("register_date")
    ).select("client_id", "app", "stage", "register_date", "complete_process")


@memo_view
def clients_batch(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """Catalog drops: batch 1 = customers with ``custkey % 4 <> 3``; batch
    2 = customers with ``custkey % 4 <> 0`` where every 5th changes email
    and every 11th has an age where batch 1 had NULL or vice versa."""
    cat = clients(spark, sf_dir)
    k = (F.col("client_id").cast("bigint") - ID_OFFSET)
    if batch == 1:
        return cat.filter(k % 4 != 3)
    return cat.filter(k % 4 != 0).select(
        "client_id",
        "name",
        F.when(k % 5 == 0, F.concat(F.lit("new."), F.col("email"))).otherwise(F.col("email")).alias("email"),
        F.when(k % 11 == 0, F.when(F.col("age").isNull(), F.lit(40)).otherwise(F.lit(None)))
        .otherwise(F.col("age"))
        .cast("int")
        .alias("age"),
        "state",
    )


@memo_view
def catalog_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated observations of clients' attributes, from every fifth order: client_id, changed_on,
    email (some NULL), state (a nation near the customer's), load_no (the order key)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    moved = o.where(k % 5 == 0).join(c, F.col("o_custkey") == F.col("c_custkey"))
    email = F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("."), (k % 3).cast("string"), F.lit("@example.com"))
    return moved.join(n, (F.col("c_nationkey") + (k / 5).cast("bigint") % 4) % 25 == F.col("n_nationkey")).select(
        _client_id(F.col("o_custkey")).alias("client_id"), F.col("o_orderdate").cast("date").alias("changed_on"),
        F.when(k % 10 != 0, email).alias("email"), F.col("n_name").alias("state"), k.alias("load_no"))


@memo_view
def misspelt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``funnel_events`` with damaged labels: accents, a lost, doubled or wrong letter, other case and blanks, by order key."""
    ev = funnel_events(spark, sf_dir, with_key=True)
    s, k = F.col("stage"), F.col("o_orderkey") % 11
    place = (F.col("o_orderkey") % 5 + 2).cast("int")
    stage = (
        F.when(k == 0, F.replace(s, F.lit("cion"), F.lit("ción")))
        .when(k == 1, F.concat(F.substring(s, F.lit(1), place), F.substring(s, place + 2, F.lit(100))))
        .when(k == 2, F.concat(F.substring(s, F.lit(1), place), F.substring(s, place, F.lit(100))))
        .when(k == 3, F.overlay(s, F.lit("x"), place)).when(k == 4, F.concat(F.lit("  "), F.upper(s)))
        .when(k == 5, F.concat(F.lit("yz"), F.overlay(s, F.lit("xxxx"), place))).otherwise(s))
    return ev.withColumn("stage", stage).drop("o_orderkey")


#: Drops of the landing area that the reports are kept up from.
DROPS = 4


@memo_view
def funnel_drop(spark: SparkSession, sf_dir: str, drop: int) -> DataFrame:
    """Drop 1 to DROPS: stage events dealt by order key, so dates of all years come in each drop and
    later ones bring earlier dates; one row per client and stage with the earliest date of the drop."""
    ev = funnel_events(spark, sf_dir, with_key=True).where(F.floor(F.col("o_orderkey") / 7) % DROPS == drop - 1)
    return ev.groupBy("client_id", "app", "stage", "complete_process").agg(F.min("register_date").alias("register_date")).select(
        "client_id", "app", "stage", "register_date", "complete_process")


@memo_view
def clients_drop(spark: SparkSession, sf_dir: str, drop: int) -> DataFrame:
    """Catalog of a drop: half of the customers each time (``(custkey + drop) % 2``, all in the first), a third of
    which have moved on by ``drop`` nations and grown older by ``drop``."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    here = c.where((k % 17 != 0) & ((F.lit(drop) == 1) | ((k + drop) % 2 == 0)))
    moved = F.when(k % 3 == 0, F.lit(drop)).otherwise(0)
    age = F.when(k % 23 != 0, 16 + (k * 7) % 50 + moved).cast("int")
    return here.join(n, (F.col("c_nationkey") + moved) % 25 == F.col("n_nationkey")).select(
        _client_id(k).alias("client_id"), F.col("c_name").alias("name"),
        F.concat(F.lit("c"), k.cast("string"), F.lit("@example.com")).alias("email"), age.alias("age"), F.col("n_name").alias("state"))
