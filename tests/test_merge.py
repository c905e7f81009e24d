import datetime as dt

import pytest
from pyspark.sql import functions as F

from stagewise.functions.exprs import timestamp_value
from stagewise.operators.merge import (
    AmbiguousMergeError,
    Insert,
    NullKeyError,
    Update,
    changed_condition,
    dedupe_latest,
    insert_only,
    merge,
    merge_inserts,
    upsert_all,
)

from .conftest import rows

T = "client_id string, stage string, d date, ts timestamp"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
TS1, TS2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def _t(spark, data):
    return spark.createDataFrame(data, T)


def test_upsert_all_replaces_every_column_and_inserts(spark):
    # M1: a matched row is replaced even when only the load stamp differs.
    tgt = _t(spark, [("1", "a", D1, TS1), ("2", "a", D1, TS1)])
    src = _t(spark, [("1", "a", D1, TS2), ("3", "a", D2, TS2)])
    got = rows(upsert_all(tgt, src, ["client_id", "stage"]))
    assert got == rows(_t(spark, [("1", "a", D1, TS2), ("2", "a", D1, TS1), ("3", "a", D2, TS2)]))


def test_null_key_never_matches_and_is_inserted_each_run(spark):
    # Rule 1: '=' on keys; a NULL-key row is inserted again on every run.
    tgt = _t(spark, [("1", "a", D1, TS1)])
    src = _t(spark, [(None, "a", D2, TS2)])
    once = upsert_all(tgt, src, ["client_id", "stage"])
    twice = upsert_all(once, src, ["client_id", "stage"])
    assert twice.filter(F.col("client_id").isNull()).count() == 2
    assert upsert_all(tgt, src, ["client_id", "stage"], null_keys="drop").count() == 1
    with pytest.raises(NullKeyError):
        upsert_all(tgt, src, ["client_id", "stage"], null_keys="error")


def test_insert_only_never_touches_existing_and_keeps_duplicates(spark):
    # M2 + rule 3: insert-only accepts duplicate source rows and inserts all.
    tgt = _t(spark, [("1", "a", D1, TS1)])
    src = _t(spark, [("1", "a", D2, TS2), ("2", "a", D2, TS2), ("2", "a", D2, TS2)])
    got = rows(insert_only(tgt, src, ["client_id", "stage"]))
    assert got == rows(_t(spark, [("1", "a", D1, TS1), ("2", "a", D2, TS2), ("2", "a", D2, TS2)]))
    only_new = merge_inserts(tgt, src, ["client_id", "stage"])
    assert only_new.count() == 2


def test_ambiguous_update_raises(spark):
    # Rule 3: two source rows for one target row with an update clause.
    tgt = _t(spark, [("1", "a", D1, TS1)])
    src = _t(spark, [("1", "a", D2, TS2), ("1", "a", D1, TS2)])
    with pytest.raises(AmbiguousMergeError):
        upsert_all(tgt, src, ["client_id", "stage"])
    # Duplicates that match nothing are inserted, not an error.
    src2 = _t(spark, [("9", "a", D2, TS2), ("9", "a", D1, TS2)])
    assert upsert_all(tgt, src2, ["client_id", "stage"]).count() == 3


CAT = "client_id string, name string, age int, ingestion_date timestamp, update_date timestamp"


def test_conditional_update_strict_vs_null_safe(spark):
    # NULL -> value is no change under '<>'.
    tgt = spark.createDataFrame([("1", "Ana", None, TS1, None), ("2", "Bo", 30, TS1, None)], CAT)
    src = spark.createDataFrame([("1", "Ana", 40, TS2), ("2", "Bo", 31, TS2), ("3", "Cy", 20, TS2)],
                                "client_id string, name string, age int, ingestion_date timestamp")
    now = timestamp_value("2024-03-01 00:00:00")

    def run(mode):
        return merge(
            tgt, src, ["client_id"],
            Update({"name": "s.name", "age": "s.age", "ingestion_date": "s.ingestion_date", "update_date": now},
                   changed_condition(["name", "age"], mode)),
            Insert({"client_id": "s.client_id", "name": "s.name", "age": "s.age",
                    "ingestion_date": "s.ingestion_date", "update_date": "Null"}),
        )

    strict = {r.client_id: r for r in run("strict").collect()}
    assert strict["1"].age is None and strict["1"].update_date is None   # not updated
    assert strict["2"].age == 31 and strict["2"].update_date == dt.datetime(2024, 3, 1)
    assert strict["3"].update_date is None and strict["3"].age == 20     # inserted with NULL update_date
    safe = {r.client_id: r for r in run("null_safe").collect()}
    assert safe["1"].age == 40 and safe["1"].ingestion_date == TS2


def test_sql_text_condition_and_values(spark):
    # M6: string conditions/values use the aliases; unnamed insert columns are NULL (rule 4).
    tgt = spark.createDataFrame([("1", "Ana", 30, TS1, None)], CAT)
    src = spark.createDataFrame([("1", "Ann", 30), ("2", "Bo", 5)], "client_id string, name string, age int")
    out = merge(tgt, src, ["client_id"],
                Update({"name": "upper(s.name)"}, "t.name <> s.name"),
                Insert({"client_id": "s.client_id", "age": "s.age + 1"}),
                target_alias="t", source_alias="s")
    got = {r.client_id: r for r in out.collect()}
    assert got["1"].name == "ANN" and got["1"].ingestion_date == TS1
    assert got["2"].name is None and got["2"].age == 6 and got["2"].ingestion_date is None


def test_merge_on_a_condition_with_differently_named_keys(spark):
    tgt = spark.createDataFrame([("1", "Ana", 30, TS1, None), ("2", "Bo", 40, TS1, None), (None, "No", 1, TS1, None)], CAT)
    src = spark.createDataFrame([("1", 31), ("2", 39), (None, 9)], "id string, years int")
    on = "t.client_id = s.id AND s.years > t.age"
    ins = Insert({"client_id": "s.id", "age": "s.years"})
    got = sorted((str(r.client_id), r.age) for r in merge(tgt, src, on, Update({"age": "s.years"}), ins).collect())
    assert got == [("1", 31), ("2", 39), ("2", 40), ("None", 1), ("None", 9)]
    only = merge(tgt, src, F.col("t.client_id") == F.col("s.id"), None, ins)
    assert sorted((str(r.client_id), r.age) for r in only.collect()) == [("1", 30), ("2", 40), ("None", 1), ("None", 9)]
    with pytest.raises(AmbiguousMergeError):
        merge(tgt, src.unionByName(src), on, Update({"age": "s.years"}), ins)
    with pytest.raises(ValueError):
        merge(tgt, src, on, Update({"age": "s.years"}), ins, null_keys="drop")


def test_update_all_matches_names_without_case_and_needs_every_column(spark):
    tgt = spark.createDataFrame([("1", "old")], "k string, v string")
    src = spark.createDataFrame([("1", "x"), ("2", "y")], "K string, V string")
    assert rows(upsert_all(tgt, src, ["k"])) == [{"k": "1", "v": "x"}, {"k": "2", "v": "y"}]
    with pytest.raises(ValueError):
        upsert_all(tgt, src.drop("V"), ["k"])


def test_insert_condition_is_three_valued(spark):
    tgt = _t(spark, [])
    src = spark.createDataFrame([("1", "a", None, TS1), ("2", "a", D1, TS1)], T)
    out = merge(tgt, src, ["client_id", "stage"], None, Insert(condition="s.d > DATE'2000-01-01'"))
    assert [r.client_id for r in out.collect()] == ["2"]


def test_merge_same_batch_twice_is_stable(spark):
    # Property: without NULL keys, re-merging the same batch changes nothing but stamps.
    tgt = _t(spark, [("1", "a", D1, TS1), ("2", "b", D1, TS1)])
    src = _t(spark, [("2", "b", D2, TS2), ("3", "c", D2, TS2)])
    once = upsert_all(tgt, src, ["client_id", "stage"])
    twice = upsert_all(once, src, ["client_id", "stage"])
    assert rows(once) == rows(twice)


def test_target_null_key_rows_pass_through(spark):
    tgt = _t(spark, [(None, "a", D1, TS1), ("1", "a", D1, TS1)])
    src = _t(spark, [("1", "a", D2, TS2)])
    out = upsert_all(tgt, src, ["client_id", "stage"])
    assert out.count() == 2 and out.filter(F.col("client_id").isNull()).first().d == D1


def test_dedupe_latest(spark):
    # T7 option: keep the latest row per key (partial-aggregated max_by).
    df = _t(spark, [("1", "a", D1, TS1), ("1", "a", D2, TS2), ("2", "a", D1, TS1)])
    got = {r.client_id: r.d for r in dedupe_latest(df, ["client_id", "stage"], "ts").collect()}
    assert got == {"1": D2, "2": D1}


def test_self_merge_from_same_lineage(spark):
    base = _t(spark, [("1", "a", D1, TS1), ("2", "a", D1, TS1)])
    src = base.filter("client_id = '2'").withColumn("d", F.lit(D2))
    out = {r.client_id: r.d for r in upsert_all(base, src, ["client_id", "stage"]).collect()}
    assert out == {"1": D1, "2": D2}


def test_condition_without_an_equality_is_refused(spark):
    t = spark.createDataFrame([(1, 10)], "k int, v int")
    s = spark.createDataFrame([(1, 20), (2, 5)], "k int, v int")
    for cond in ("s.v > t.v", "t.k = 1 AND s.k > 0"):
        with pytest.raises(ValueError, match="no equality"):
            merge(t, s, cond, Update(), Insert())
    out = merge(t, s, "s.v > t.v", Update(), Insert(), allow_nested_loop=True)
    assert sorted(map(tuple, out.collect())) == [(1, 20), (2, 5)]
    assert sorted(map(tuple, merge(t, s, "t.k = s.k AND s.v > t.v", Update(), Insert()).collect())) == [(1, 20), (2, 5)]
