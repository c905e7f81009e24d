import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stagewise.functions.exprs import age_group, any_differs, bucket, flag, map_values, quality_check
from stagewise.functions.parse import conform, parse_date, parse_int, parse_timestamp
from stagewise.functions.quality import reject_counts
from stagewise.schemas import CLIENTS_CONFORM, STAGE_LABEL_TO_COLUMN


def test_age_boundaries_and_catch_all(spark):
    # NULL and under-18 ages fall into the catch-all, like the source system.
    ages = [17, 18, 25, 26, 35, 36, 50, 51, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = {r.age: r.g for r in df.select("age", age_group("age").alias("g")).collect()}
    assert got == {17: "50+", 18: "18-25", 25: "18-25", 26: "26-35", 35: "26-35",
                   36: "36-50", 50: "36-50", 51: "50+", None: "50+"}


def test_bucket_options(spark):
    df = spark.createDataFrame([(None,), (10,), (20,)], "age int")
    got = {r.age: r.g for r in df.select("age", bucket("age", other="other", null_label="unknown").alias("g")).collect()}
    assert got == {None: "unknown", 10: "other", 20: "18-25"}


def test_quality_flag_nulls_fail(spark):
    df = spark.createDataFrame(
        [("10001", 1), ("123", 0), ("10002", 2), ("10003", None), (None, 1)],
        "client_id string, complete_process int")
    got = {(r.client_id, r.complete_process): r.q for r in df.select("*", quality_check().alias("q")).collect()}
    assert got[("10001", 1)] == "Passed"
    assert got[("123", 0)] == "Not Passed"
    assert got[("10002", 2)] == "Not Passed"
    assert got[("10003", None)] == "Not Passed"
    assert got[(None, 1)] == "Not Passed"


def test_flag_null_predicate_is_failed(spark):
    df = spark.createDataFrame([(None,)], "x int")
    assert df.select(flag(F.col("x") > 1).alias("f")).first().f == "Not Passed"


def test_map_values_unknown_and_null(spark):
    df = spark.createDataFrame([("Firma",), ("Otro",), (None,)], "stage string")
    got = {r.stage: r.m for r in df.select("stage", map_values("stage", STAGE_LABEL_TO_COLUMN).alias("m")).collect()}
    assert got == {"Firma": "signature", "Otro": None, None: None}


def test_parse_date_two_formats_and_junk(spark):
    # Bad text must not fail the load (ANSI casts would raise).
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("2024-01-05",), ("2024/01/05",), ("not-a-date",), (None,)], "d string")
    got = {r.d: r.p for r in df.select("d", parse_date("d").alias("p")).collect()}
    assert got == {"2024-01-05": dt.date(2024, 1, 5), "2024/01/05": dt.date(2024, 1, 5),
                   "not-a-date": None, None: None}


def test_plain_cast_of_junk_raises_under_ansi(spark):
    df = spark.createDataFrame([("x",)], "d string")
    with pytest.raises(Exception):
        df.select(F.col("d").cast("int")).collect()
    assert df.select(parse_int("d").alias("i")).first().i is None


def test_parse_timestamp(spark):
    df = spark.createDataFrame([("2024/01/05 10:11:12",), ("2024-01-05 10:11:12",), ("junk",)], "t string")
    got = {r.t: r.p for r in df.select("t", parse_timestamp("t").alias("p")).collect()}
    assert got["2024/01/05 10:11:12"] == dt.datetime(2024, 1, 5, 10, 11, 12)
    assert got["2024-01-05 10:11:12"] == dt.datetime(2024, 1, 5, 10, 11, 12)
    assert got["junk"] is None


def test_conform_and_reject_counts(spark):
    raw = spark.createDataFrame(
        [("10001", "Ana", "a@x", "30", "Jalisco", "2024-01-01 00:00:00"),
         ("10002", "Bo", "b@x", "x", "Colima", "2024-01-01 00:00:00"),
         ("10003", "Cy", "c@x", None, None, "2024-01-01 00:00:00")],
        "ID_cliente string, Nombre string, Correo string, Edad string, Estado string, fecha_ingesta string")
    out = conform(raw, CLIENTS_CONFORM)
    assert out.columns == ["client_id", "name", "email", "age", "state", "ingestion_date"]
    assert dict(out.dtypes)["age"] == "int"
    assert {r.client_id: r.age for r in out.collect()} == {"10001": 30, "10002": None, "10003": None}
    rej = reject_counts(raw, CLIENTS_CONFORM).first()
    assert rej.rows == 3 and rej.rejected_age == 1 and rej.rejected_ingestion_date == 0


def test_conform_already_typed_is_noop(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2),)], "d date")
    out = conform(df, {"d": ("register_date", "date")})
    assert out.first().register_date == dt.date(2024, 1, 2)


def test_change_modes(spark):
    # Strict '<>' does not see NULL -> value as a change; null-safe does.
    df = spark.createDataFrame([(None, 1), (1, 1), (1, 2)], "a int, b int")
    strict = [r.c for r in df.select(any_differs([(F.col("a"), F.col("b"))], "strict").alias("c")).collect()]
    safe = [r.c for r in df.select(any_differs([(F.col("a"), F.col("b"))], "null_safe").alias("c")).collect()]
    assert strict == [None, False, True]
    assert safe == [True, False, True]
    with pytest.raises(ValueError):
        any_differs([(F.col("a"), F.col("b"))], "fuzzy")


def test_unknown_column_in_conform_fails(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises((AnalysisException, KeyError)):
        conform(df, {"missing": ("m", "int")})


def test_cluster_conf_sizes_partitions():
    from stagewise.session import cluster_conf

    c = cluster_conf(100 * 2**40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600           # 100 TiB / 256 MiB
    assert int(cluster_conf(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 16   # at least 2 waves
