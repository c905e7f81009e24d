import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stagewise.operators.merge import Insert, Update
from stagewise.schemas import FUNNEL_SOURCE_COLUMNS, SILVER_FUNNEL
from stagewise.session import scratch_dir
from stagewise.sources.landing import read_landing, with_load_ts, write_landing
from stagewise.sources.tables import (
    create_or_merge,
    ensure_table,
    merge_into,
    publish,
    read_table,
    table_exists,
)


def test_ensure_table_is_create_if_absent(spark, tmp_path):
    # A second run must not fail with PATH_ALREADY_EXISTS.
    root = str(tmp_path / "silver" / "users_funnel")
    assert not table_exists(spark, root)
    assert ensure_table(spark, root, SILVER_FUNNEL) is True
    assert ensure_table(spark, root, SILVER_FUNNEL) is False
    t = read_table(spark, root)
    assert t.count() == 0 and t.schema == SILVER_FUNNEL




def test_merge_into_insert_only_appends(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark.createDataFrame([("1", 1)], "k string, v int"), root, ["k"])
    merge_into(spark, root, spark.createDataFrame([("1", 9), ("2", 2)], "k string, v int"), ["k"])
    assert {r.k: r.v for r in read_table(spark, root).collect()} == {"1": 1, "2": 2}
    merge_into(spark, root, spark.createDataFrame([("2", 5)], "k string, v int"), ["k"], Update(), Insert())
    assert {r.k: r.v for r in read_table(spark, root).collect()} == {"1": 1, "2": 5}


def _csv(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_landing_read_and_create_or_merge(spark, tmp_path):
    landing1, landing2 = str(tmp_path / "l1"), str(tmp_path / "l2")
    _csv(f"{landing1}/usuarios_banco_con_funnel.csv",
         "ID_cliente,App,stage,date,Proceso_completo\n10001,ios,Introduccion,2024-01-01,1\n"
         "10002,android,Introduccion,2024/01/03,0\n")
    _csv(f"{landing2}/usuarios_banco_con_funnel.csv",
         "ID_cliente,App,stage,date,Proceso_completo\n10002,android,Introduccion,2024-01-04,0\n"
         "10003,ios,Firma,2024-01-05,0\n")
    bronze = str(tmp_path / "bronze")
    for landing, ts in ((landing1, "2024-01-01 00:00:00"), (landing2, "2024-02-01 00:00:00")):
        src = with_load_ts(read_landing(spark, landing, "usuarios_banco_con_funnel", FUNNEL_SOURCE_COLUMNS),
                           ts=ts)
        create_or_merge(spark, bronze, src, ["ID_cliente", "stage"])
    got = {r.ID_cliente: (r.date, r.fecha_ingesta) for r in read_table(spark, bronze).collect()}
    assert got == {
        "10001": ("2024-01-01", dt.datetime(2024, 1, 1)),
        "10002": ("2024-01-04", dt.datetime(2024, 2, 1)),
        "10003": ("2024-01-05", dt.datetime(2024, 2, 1)),
    }


def test_landing_header_mismatch_fails(spark, tmp_path):
    landing = str(tmp_path / "l")
    _csv(f"{landing}/usuarios_banco_con_funnel.csv", "ID,App,stage,date,Proceso_completo\n1,a,b,c,d\n")
    with pytest.raises(Exception):
        read_landing(spark, landing, "usuarios_banco_con_funnel", FUNNEL_SOURCE_COLUMNS).collect()


def test_write_landing_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("1", 2, None)], "a string, b int, c string")
    write_landing(df, str(tmp_path), "x")
    back = spark.read.option("header", True).csv(str(tmp_path / "x.csv"))
    assert back.first().asDict() == {"a": "1", "b": "2", "c": None}










def test_create_or_merge_dedupe_by(spark, tmp_path):
    from stagewise.operators.merge import AmbiguousMergeError

    root = str(tmp_path / "d")
    dup = spark.createDataFrame([("1", 1, "a"), ("1", 2, "b"), ("2", 1, "c")], "k string, seq int, v string")
    create_or_merge(spark, root, dup, ["k"])                       # T7: duplicates kept on first load
    assert read_table(spark, root).count() == 3
    with pytest.raises(AmbiguousMergeError):
        create_or_merge(spark, root, dup, ["k"])
    root2 = str(tmp_path / "d2")
    create_or_merge(spark, root2, dup, ["k"], dedupe_by="seq")
    create_or_merge(spark, root2, dup, ["k"], dedupe_by="seq")
    assert {r.k: r.v for r in read_table(spark, root2).collect()} == {"1": "b", "2": "c"}


def test_create_or_merge_null_keys_on_first_load(spark, tmp_path):
    from stagewise.operators.merge import NullKeyError

    df = spark.createDataFrame([(None, 1), ("1", 2)], "k string, v int")
    create_or_merge(spark, str(tmp_path / "a"), df, ["k"], null_keys="drop")
    assert read_table(spark, str(tmp_path / "a")).count() == 1
    with pytest.raises(NullKeyError):
        create_or_merge(spark, str(tmp_path / "b"), df, ["k"], null_keys="error")
    create_or_merge(spark, str(tmp_path / "c"), df, ["k"])
    assert read_table(spark, str(tmp_path / "c")).count() == 2


def _files(root):
    return {d: sorted(f for f in os.listdir(os.path.join(root, d)) if f.endswith(".parquet"))
            for d in os.listdir(root) if d.startswith("sw_bucket=")}


def test_merge_touches_only_the_buckets_of_its_keys(spark, tmp_path):
    from stagewise.sources.tables import bucket_expr

    root = str(tmp_path / "b")
    rows = spark.range(0, 200).selectExpr("cast(id as string) as k", "cast(id as int) as v")
    publish(rows, root, ["k"], buckets=8)
    before = _files(root)
    assert len(before) == 8 and read_table(spark, root).columns == ["k", "v"]   # no bucket column leaks
    src = spark.createDataFrame([("5", 50), ("900", 9)], "k string, v int")
    hit = {f"sw_bucket={r[0]}" for r in src.select(bucket_expr(["k"], 8)).collect()}
    merge_into(spark, root, src, ["k"], Update(), Insert(), buckets=8)
    after = _files(root)
    assert {d for d in after if after[d] != before[d]} == hit
    got = {r.k: r.v for r in read_table(spark, root).collect()}
    assert got["5"] == 50 and got["900"] == 9 and len(got) == 201
    merge_into(spark, root, src, ["k"], buckets=8)                              # insert-only, nothing new
    assert read_table(spark, root).count() == 201


def test_empty_source_and_null_keys(spark, tmp_path):
    root = str(tmp_path / "n")
    publish(spark.createDataFrame([("1", 1), (None, 7)], "k string, v int"), root, ["k"], buckets=4)
    merge_into(spark, root, spark.createDataFrame([], "k string, v int"), ["k"], Update(), Insert(), buckets=4)
    merge_into(spark, root, spark.createDataFrame([(None, 8), ("1", 2)], "k string, v int"), ["k"], Update(), Insert(), buckets=4)
    assert sorted(((r.k or ""), r.v) for r in read_table(spark, root).collect()) == [("", 7), ("", 8), ("1", 2)]


def test_scratch_is_removed_when_a_merge_fails(spark, tmp_path):
    from stagewise.operators.merge import AmbiguousMergeError
    from stagewise.session import checkpoint_root

    root = str(tmp_path / "f")
    publish(spark.createDataFrame([("1", 1)], "k string, v int"), root, ["k"])
    scratch = os.path.join(checkpoint_root(spark).removeprefix("file:"), "stagewise")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    with pytest.raises(AmbiguousMergeError):
        merge_into(spark, root, spark.createDataFrame([("1", 2), ("1", 3)], "k string, v int"), ["k"], Update(), Insert())
    assert set(os.listdir(scratch)) == before


def test_update_all_needs_every_column_and_ignores_case(spark):
    from stagewise.operators.merge import upsert_all

    target = spark.createDataFrame([("1", 1)], "k string, v int")
    out = upsert_all(target, spark.createDataFrame([("1", 5), ("2", 6)], "K string, V int"), ["k"])
    assert sorted(map(tuple, out.collect())) == [("1", 5), ("2", 6)]
    with pytest.raises(ValueError, match="missing"):
        upsert_all(target, spark.createDataFrame([("1",)], "k string"), ["k"])


def test_updating_merge_scans_and_shuffles_each_side_once(spark, tmp_path):
    from stagewise.operators.merge import merge

    for name, n in (("t", 50), ("s", 20)):
        spark.range(n).selectExpr("cast(id as string) as k", "1 as v").write.parquet(str(tmp_path / name))
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        t, s = (spark.read.parquet(str(tmp_path / name)) for name in "ts")
        plan = merge(t, s, ["k"], Update(), Insert(), materialize_source=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 2


def test_scratch_folder_must_be_shared_off_local_masters():
    from stagewise.session import scratch_root

    assert scratch_root(None, None, "local[8]") is None and scratch_root(None, "hdfs://x", "yarn") == "hdfs://x"
    assert scratch_root("file:/a", None, "spark://h:1") == "file:/a"
    for master in ("yarn", "spark://h:1", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            scratch_root(None, None, master)


def test_new_rows_without_a_key_overwrite_no_other_bucket(spark):
    """Their bucket is by content, and must be one of those that the MERGE reads and replaces."""
    root = f"{scratch_dir(spark, 'nullkeys')}/t"
    publish(spark.range(200).selectExpr("CAST(id AS STRING) AS k", "CAST(id AS INT) AS v", "CAST(NULL AS STRING) AS note"), root, ["k"], 16)
    for i in range(6):
        src = spark.createDataFrame([("7", 1000 + i), (None, i), (None, 100 + i)], "k string, v int")
        merge_into(spark, root, src, ["k"], Update({"v": "s.v"}), Insert({"k": "s.k", "v": "s.v", "note": F.lit(f"n{i}")}), buckets=16)
    rows = read_table(spark, root).collect()
    assert len(rows) == 212 and {r.k for r in rows} == {None, *map(str, range(200))}
    assert sum(r.k is None for r in rows) == 12 and [r.v for r in rows if r.k == "7"] == [1005]
