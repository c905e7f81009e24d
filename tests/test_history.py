"""Catalog history: late and repeated drops in any order, and the join as of a date, against plain-Python models."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from stagewise.operators import history as hs

DAY = dt.date(2024, 1, 1)
SCHEMA = "k string, on_day date, a string, b int, load int"


def _observations(seed=1, n=120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = rng.choice(["x", "y", "z", "hot", "hot", "hot", None])
        day = None if rng.random() < 0.03 else DAY + dt.timedelta(rng.randrange(200))
        rows.append((k, day, rng.choice(["p", "q", None]), rng.choice([1, 2, None]), rng.choice([i, i, None])))
    return rows


def _order(v):
    return (v is not None, v if v is not None else 0) if not isinstance(v, str) else (True, v)


def _model(rows):
    best = {}
    for k, day, a, b, load in rows:
        if k is None or day is None:
            continue
        rank = (load is not None, load or 0, (a is not None, a or ""), (b is not None, b or 0))
        if (k, day) not in best or rank > best[k, day][0]:
            best[k, day] = rank, (a, b, load)
    out = []
    for k in {k for k, _ in best}:
        days = sorted(d for x, d in best if x == k)
        for d, following in zip(days, [*days[1:], None]):
            out.append((k, *best[k, d][1], d, following))
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r) for r in df.select("k", "a", "b", "load", "valid_from", "valid_to").collect()), key=str)


def test_history_and_every_order_of_drops(spark):
    rows = _observations()
    drops = [rows[0::3], rows[1::3], rows[2::3]]
    want = _model(rows)
    df = lambda r: spark.createDataFrame(r, SCHEMA)
    assert _got(hs.history(df(rows), ["k"], ["a", "b"], "on_day", "load")) == want
    for order in itertools.permutations(range(3)):
        known = hs.history(df(drops[order[0]]), ["k"], ["a", "b"], "on_day", "load")
        for i in order[1:]:
            known = hs.splice(known, df(drops[i]), ["k"], ["a", "b"], "on_day", "load")
        assert _got(known) == want
    again = hs.splice(known, df(drops[0]), ["k"], ["a", "b"], "on_day", "load")
    assert _got(again) == want                              # the same drop again changes nothing


def test_a_late_row_splits_an_interval_that_repeats_its_attributes(spark):
    rows = [("x", DAY, "p", 1, 1), ("x", DAY + dt.timedelta(20), "p", 1, 2)]
    known = hs.history(spark.createDataFrame(rows, SCHEMA), ["k"], ["a", "b"], "on_day", "load")
    assert [(r.valid_from, r.valid_to, r.is_current) for r in hs.collapsed(known, ["k"], ["a", "b"]).collect()] == [(DAY, None, True)]
    late = spark.createDataFrame([("x", DAY + dt.timedelta(10), "q", 1, 3)], SCHEMA)
    out = hs.collapsed(hs.splice(known, late, ["k"], ["a", "b"], "on_day", "load"), ["k"], ["a", "b"])
    assert sorted((r.a, (r.valid_from - DAY).days, r.valid_to and (r.valid_to - DAY).days, r.is_current) for r in out.collect()) == [
        ("p", 0, 10, False), ("p", 20, None, True), ("q", 10, 20, False)]


@pytest.mark.parametrize("block", ["month", "year", "day"])
def test_asof_join_equals_model(spark, block):
    rows, rng = _observations(3), random.Random(2)
    events = [(rng.choice(["x", "y", "z", "hot", "none", None]), None if i % 40 == 0 else DAY + dt.timedelta(rng.randrange(-20, 260)), i) for i in range(300)]
    known = hs.history(spark.createDataFrame(rows, SCHEMA), ["k"], ["a", "b"], "on_day", "load")
    out = hs.asof_join(spark.createDataFrame(events, "k string, at date, n int").repartition(3), known, ["k"], "at", ["a", "b"], block)
    assert out.columns == ["k", "at", "n", "a", "b"]
    model = _model(rows)

    def valid(k, at):
        hits = [(a, b) for x, a, b, _, start, end in model if x == k and at is not None and start <= at and (end is None or at < end)]
        return hits[0] if hits else (None, None)

    assert sorted(map(tuple, out.collect()), key=str) == sorted(((k, at, n, *valid(k, at)) for k, at, n in events), key=str)


def test_asof_join_deals_a_hot_key_over_its_blocks(spark):
    """A key with all rows meets no task alone: rows are shuffled by key and block."""
    events = spark.range(5000).selectExpr("'hot' AS k", "date_add(DATE'2020-01-01', CAST(id % 1500 AS INT)) AS at", "id AS n")
    known = hs.history(spark.range(700).selectExpr("'hot' AS k", "date_add(DATE'2020-01-01', CAST(2 * id AS INT)) AS on_day",
                                                   "CAST(id AS STRING) AS a", "CAST(id AS INT) AS b", "1 AS load"), ["k"], ["a", "b"], "on_day", "load")
    out = hs.asof_join(events, known, ["k"], "at", ["b"])
    assert out.where("b <> LEAST(datediff(at, DATE'2020-01-01') DIV 2, 699)").count() == 0 and out.count() == 5000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "hashpartitioning(__k0" in plan and "__block" in plan
    with pytest.raises(ValueError):
        hs.asof_join(events.withColumn("B", F.lit(1)), known, ["k"], "at", ["b"])
