"""A hot key holding a third of all rows must not change any result
(it is reduced map-side by partial aggregation, or split by AQE)."""

from pyspark.sql import functions as F

from stagewise.operators import funnel as fn
from stagewise.operators.merge import dedupe_latest, insert_only, upsert_all
from stagewise.plans import gold

N = 30_000


def _skewed_funnel(spark):
    ids = F.when(F.col("id") % 3 == 0, F.lit("10001")).otherwise((F.col("id") % 997 + 20000).cast("string"))
    labels = F.element_at(F.array(*[F.lit(x) for x in ("Introduccion", "Firma", "Confirmacion de datos")]),
                          (F.col("id") % 3 + 1).cast("int"))
    return spark.range(N).select(
        ids.alias("client_id"), F.lit("ios").alias("app"), labels.alias("stage"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("register_date"),
        F.lit(0).alias("complete_process"))


def test_hot_client_pivot_and_reports(spark):
    f = _skewed_funnel(spark)
    cat = f.select("client_id").distinct().select("client_id", F.lit("n").alias("name"), F.lit("e").alias("email"),
                                                  F.lit(30).alias("age"), F.lit("S").alias("state"))
    pv = gold.client_stage_dates(f, cat)
    assert pv.count() == pv.select("client_id").distinct().count()
    hot = pv.filter("client_id = '10001'").first()
    assert hot.introduction.isoformat() == "2024-01-01"   # id % 3 == 0 rows are all Introduccion
    assert fn.reached(pv).first().TI == pv.count()


def test_hot_key_merges(spark):
    f = _skewed_funnel(spark)
    tgt = f.filter("client_id <> '10001'").dropDuplicates(["client_id", "stage"])
    out = insert_only(tgt, f, ["client_id", "stage"])
    assert out.filter("client_id = '10001'").count() == N // 3      # duplicates all inserted
    latest = dedupe_latest(f, ["client_id", "stage"], "register_date")
    assert latest.filter("client_id = '10001'").count() == 1
    up = upsert_all(tgt, latest, ["client_id", "stage"])
    assert up.count() == latest.count()
