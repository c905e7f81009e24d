"""Reports kept up from changes: equal to the full recompute after every drop, also after a run that died."""

import pytest
from pyspark.sql import functions as F

from stagewise.operators import funnel, reports
from stagewise.plans import analysis_queries as aq
from stagewise.plans import report_state as rs
from stagewise.plans.incremental import report_state
from stagewise.schemas import GOLD_PIVOT
from stagewise.session import scratch_dir
from stagewise.sources.tables import publish, read_table

from .conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect()))


def _full(pv):
    return {
        "funnel_global": funnel.reached(pv), "funnel_state": funnel.reached(pv, ["state"]), "funnel_state_age": funnel.funnel_state_age(pv),
        "conversion_global": funnel.conversion_global(pv), "conversion_per_state": funnel.conversion_per_state(pv),
        "conversion_by_age": funnel.conversion_by_age(pv), "abandonment": funnel.abandonment(pv), "state_clients": reports.state_clients(pv),
        "state_completed": reports.state_completed(pv), "state_open": reports.state_open(pv),
        "confirmed_not_complete": reports.confirmed_not_complete(pv), "avg_days_state": reports.avg_days_state(pv),
        "avg_days_per_stage": funnel.avg_days_per_stage(pv),
    }


def test_every_report_after_four_drops(spark):
    for drop, layers in aq.run_drops(spark, SF_SMALL):
        pv = read_table(spark, layers.table("gold", "pv_clients_stage"), GOLD_PIVOT)
        if drop in (1, 4):
            counts = report_state(spark, layers).counts()
            kept, full = rs.report_tables(counts), _full(pv)
            assert set(kept) == set(full)
            for name in full:
                assert kept[name].columns == full[name].columns and _rows(kept[name]) == _rows(full[name]), (drop, name)
    state = report_state(spark, layers)
    before = _rows(state.counts())
    state.compact()
    assert _rows(state.counts()) == before and state._runs("delta") == [] and len(state._runs("base")) == 1


def _pv(spark, rows):
    """(client, state, age, flag, dates of the six stages as days or None)"""
    out = []
    for c, state, age, flag, days in rows:
        dates = [None if d is None else f"2024-01-{d:02d}" for d in days]
        out.append((c, flag, "n", age, state, "e", "ios", *dates, "2024-01-01", None))
    text = spark.createDataFrame(out, ", ".join(f"{f.name} {'int' if f.name in ('complete_process', 'age') else 'string'}" for f in GOLD_PIVOT.fields))
    return text.select(*[F.col(f.name).cast(f.dataType) for f in GOLD_PIVOT.fields])


A = [("1", "x", 20, 0, (1, 2, None, None, None, None)), ("2", "x", 30, 1, (1, 2, 3, 4, 5, 6)), ("3", None, None, 0, (None,) * 6)]
B = [("1", "y", 20, 0, (1, 2, 3, None, None, None)), ("4", "x", 60, 2, (5, None, None, None, None, 9))]


def _state(spark):
    base = scratch_dir(spark, "reports")
    return rs.ReportState(spark, f"{base}/reports", f"{base}/pv", 4)


def _old(spark, state, rows):
    return read_table(spark, state.clients, GOLD_PIVOT).where(F.col("client_id").isin([r[0] for r in rows]))


@pytest.fixture
def begun(spark):
    state = _state(spark)
    publish(_pv(spark, A), state.clients, ["client_id"], 4)
    state.start()                                            # the table was there before its reports
    assert _rows(state.counts()) == _rows(rs.counted(_pv(spark, A)))
    return state


WANT = [r for r in A if r[0] != "1"] + B


def test_changed_clients_move_their_counts(spark, begun):
    begun.apply(_old(spark, begun, B), _pv(spark, B))
    assert _rows(begun.counts()) == _rows(rs.counted(_pv(spark, WANT)))
    changes = rs.signed_changes(_pv(spark, A), _pv(spark, A[1:]))
    assert [(r.client_id, r.sign) for r in changes.collect()] == [("1", -1)]      # equal rows cancel out


@pytest.mark.parametrize("step", ["before the table", "before the sums"])
def test_a_run_that_dies_is_completed_by_the_next(spark, begun, monkeypatch, step):
    died = RuntimeError("executor lost")

    def fail(*a, **k):
        raise died

    with monkeypatch.context() as m:
        m.setattr(rs, "merge_into" if step == "before the table" else "_signed_sums", fail)
        with pytest.raises(RuntimeError):
            begun.apply(_old(spark, begun, B), _pv(spark, B))
    begun.start()
    assert _rows(begun.counts()) == _rows(rs.counted(_pv(spark, WANT)))
    assert _rows(read_table(spark, begun.clients, GOLD_PIVOT)) == _rows(_pv(spark, WANT))
    begun.apply(_old(spark, begun, B), _pv(spark, B))        # the drop is run again
    assert _rows(begun.counts()) == _rows(rs.counted(_pv(spark, WANT)))


def test_the_plan_reads_the_touched_buckets_and_clients_only(spark, begun):
    touched = spark.createDataFrame([("1",), ("4",)], "client_id string")
    old = read_table(spark, begun.clients, GOLD_PIVOT, [0, 2]).join(touched, "client_id", "left_semi")
    plan = rs.signed_changes(old, _pv(spark, B))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [sw_bucket" in plan and "LeftSemi" in plan
    assert "partial_sum" in plan
