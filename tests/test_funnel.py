"""Funnel reports on hand-written rows (FIXTURES.md section 1 shapes)."""

import datetime as dt

from pyspark.sql import functions as F

from stagewise.operators import funnel as fn
from stagewise.operators import reports as rp
from stagewise.plans import gold

from .conftest import rows

D = dt.date
FUNNEL = "client_id string, app string, stage string, register_date date, complete_process int"
CATALOG = "client_id string, name string, email string, age int, state string"

ALL6 = ["Introduccion", "Solicitud de datos", "Validacion de datos", "Reconocimiento facial",
        "Firma", "Confirmacion de datos"]


def _funnel(spark):
    data = [("10001", "ios", s, D(2024, 1, 1 + i), 1) for i, s in enumerate(ALL6)]  # complete path
    data += [
        ("10002", "android", "Introduccion", D(2024, 1, 3), 0),
        ("10003", "ios", "Otro", D(2024, 1, 5), 0),                 # unknown label only
        ("12345", "ios", "Firma", D(2024, 1, 6), 0),
        ("10006", "ios", "Confirmacion de datos", D(2024, 1, 9), 0),   # confirmed, not complete
        ("10007", "ios", "Introduccion", D(2024, 1, 5), 1),
        ("10007", "ios", "Confirmacion de datos", D(2024, 1, 2), 1),   # negative days
        ("99999", "ios", "Firma", D(2024, 1, 10), 0),                  # no catalog row
    ]
    return spark.createDataFrame(data, FUNNEL)


def _catalog(spark):
    return spark.createDataFrame([
        ("10001", "A", "a@x", 18, "Jalisco"),
        ("10002", "B", "b@x", 25, "Jalisco"),
        ("10003", "C", "c@x", None, "Colima"),
        ("12345", "D", "d@x", 51, "Colima"),
        ("10006", "E", "e@x", 36, None),
        ("10007", "F", "f@x", 17, "Colima"),
    ], CATALOG)


def _pv(spark):
    return gold.client_stage_dates(_funnel(spark), _catalog(spark))


def test_pivot_plans_agree_and_keep_label_less_clients(spark):
    a = _pv(spark)
    b = gold.stage_dates_from_enriched(gold.enrich(_funnel(spark), _catalog(spark)))
    assert rows(a) == rows(b)
    pv = {r.client_id: r for r in a.collect()}
    assert "99999" not in pv                        # dropped by the inner join
    assert pv["10003"].introduction is None and all(pv["10003"][c] is None for c in gold.STAGE_COLUMNS)
    assert pv["10001"].data_confirmation == D(2024, 1, 6)


def test_pivot_with_duplicate_catalog_row_matches_reference_grouping(spark):
    cat = _catalog(spark).unionByName(_catalog(spark).filter("client_id = '10001'"))
    a = gold.client_stage_dates(_funnel(spark), cat)
    b = gold.stage_dates_from_enriched(gold.enrich(_funnel(spark), cat))
    assert rows(a) == rows(b) and a.filter("client_id = '10001'").count() == 1


def test_counts_and_didnt_finish_column_name(spark):
    pv = _pv(spark)
    assert rp.finished_all(pv).first().finished_all == 2
    out = rp.didnt_finish_all(pv)
    assert out.columns == ["didnt_finish_all"]       # T5: the column is named, not the frame
    assert out.first()[0] == 4


def test_total_time_negative_and_missing(spark):
    got = {r.client_id: r.total_time_days for r in rp.total_time(_pv(spark)).collect()}
    assert got == {"10001": 5, "10007": -3}


def test_abandonment_property_and_values(spark):
    pv = _pv(spark)
    ab = fn.abandonment(pv).first().asDict()
    assert sum(ab.values()) == pv.filter("complete_process = 0").count()
    assert ab == {"TI": 2, "TSD": 0, "TVD": 0, "TRF": 0, "TF": 1, "TCD": 1}
    top = fn.top_abandoned_stage(pv).first()
    assert (top.stage, top.Total_users) == ("TI", 2)


def test_top_abandoned_tie_prefers_earlier_stage(spark):
    pv = _pv(spark).filter("client_id IN ('10003', '12345')")   # TI = 1, TF = 1
    assert fn.top_abandoned_stage(pv).first().stage == "TI"


def test_reached_is_cumulative_and_sums_up(spark):
    pv = _pv(spark)
    g = fn.reached(pv).first()
    vals = [g[c] for c in ("TI", "TSD", "TVD", "TRF", "TF", "TCD")]
    assert vals == sorted(vals, reverse=True) and vals[0] == 6
    by_state = fn.reached(pv, ["state"]).agg(*[F.sum(c).alias(c) for c in ("TI", "TCD")]).first()
    assert (by_state.TI, by_state.TCD) == (g.TI, g.TCD)
    by_age = fn.funnel_state_age(pv).agg(F.sum("TI").alias("TI")).first()
    assert by_age.TI == g.TI


def test_reached_on_empty_input_gives_zero_row(spark):
    empty = _pv(spark).filter("false")
    r = fn.reached(empty).collect()
    assert len(r) == 1 and r[0].TI == 0
    conv = fn.conversion_global(empty).collect()
    assert len(conv) == 6 and all(c.Percentage_conversion is None for c in conv)


def test_conversion_reports(spark):
    pv = _pv(spark)
    glob = {r.stage: r for r in fn.conversion_global(pv).collect()}
    assert glob["TI"].Percentage_conversion == 100.0
    assert glob["TCD"].Total_by_stage == 3 and glob["TCD"].Percentage_conversion == 50.0
    per_state = fn.conversion_per_state(pv).collect()
    assert all(r.state is not None for r in per_state)               # NULL state left out
    assert all(r.Percentage_conversion == 100.0 for r in per_state if r.stage == "TI")
    by_age = fn.conversion_by_age(pv).collect()
    colima_ti = {r.Age_group: r.Total_TI for r in by_age if r.state == "Colima" and r.stage == "TI"}
    assert set(colima_ti.values()) == {3}                            # the state's TI, all ages
    tcd = fn.conversion_to_stage(pv, "TCD").collect()
    assert {r.stage for r in tcd} == {"TCD"}


def test_state_reports(spark):
    pv = _pv(spark)
    assert {r.state: r.Total_per_country for r in rp.confirmed_not_complete(pv).collect()} == {None: 1}
    assert {r.state: r.Total_per_country for r in rp.state_completed(pv).collect()} == {"Jalisco": 1, "Colima": 1}
    av = {r.state: r.AV for r in rp.avg_days_state(pv).collect()}
    assert av == {"Jalisco": 5.0, "Colima": -3.0}
    assert sum(r.Total_per_country for r in rp.state_clients(pv).collect()) == 6
    ordered = rp.state_clients(pv, ordered=True).collect()
    assert ordered[0].Total_per_country >= ordered[-1].Total_per_country


def test_dropoff_and_avg_days_per_stage(spark):
    pv = _pv(spark)
    d = fn.dropoff(pv).collect()
    assert [r.from_stage for r in d] == ["TI", "TSD", "TVD", "TRF", "TF"]
    assert all(r.lost == r.reached_from - r.reached_to for r in d)
    a = {r.from_stage: (r.n_clients, r.avg_days) for r in fn.avg_days_per_stage(pv).collect()}
    assert a["TI"] == (1, 1.0)


def test_unpivot_counts_matches_stack(spark):
    counts = fn.reached(_pv(spark), ["state"])
    a = fn.unpivot_counts(counts, ["state"])
    b = counts.selectExpr("state", "stack(6, 'TI', TI, 'TSD', TSD, 'TVD', TVD, 'TRF', TRF, "
                          "'TF', TF, 'TCD', TCD) as (stage, Total_users)")
    assert rows(a) == rows(b)


def test_rollup_equals_direct_reports(spark):
    pv = _pv(spark)
    r = fn.funnel_rollup(pv, materialize=True)
    assert rows(fn.funnel_rollup(pv)["funnel_state"]) == rows(r["funnel_state"])
    assert rows(r["funnel_state"]) == rows(fn.reached(pv, ["state"]))
    assert rows(r["funnel_global"]) == rows(fn.reached(pv))
    assert rows(r["conversion_global"]) == rows(fn.conversion_global(pv))
    assert rows(r["conversion_per_state"]) == rows(fn.conversion_per_state(pv))
    assert rows(r["conversion_by_age"]) == rows(fn.conversion_by_age(pv))
    empty = fn.funnel_rollup(pv.filter("false"))
    assert empty["funnel_global"].first().TI == 0


def test_ordered_reports(spark):
    pv = _pv(spark)
    g = [r.Percentage_conversion for r in fn.conversion_global(pv, ordered=True).collect()]
    assert g == sorted(g, reverse=True)
    st = [r.state for r in fn.reached(pv, ["state"], ordered=True).collect()]
    assert st == sorted(st, key=lambda x: (x is not None, x))            # NULLS FIRST
    a = [(r.state, r.Age_group, r.stage) for r in fn.conversion_by_age(pv, ordered=True).collect()]
    assert a == sorted(a)
    ids = [r.client_id for r in rp.total_time(pv, ordered=True).collect()]
    assert ids == sorted(ids) and len(ids) == 2
    av = [r.AV for r in rp.avg_days_state(pv, ordered=True).collect()]
    assert av == sorted(av, reverse=True) and len(av) == 2
    wide = pv.unionByName(pv.withColumn("state", F.lit("Sonora")))       # so that counts differ
    for report in (rp.state_completed, rp.state_open, rp.confirmed_not_complete, rp.state_clients):
        n = [r.Total_per_country for r in report(wide, ordered=True).collect()]
        assert n == sorted(n, reverse=True) and len(n) >= 2
    top = rp.first_rows(rp.state_clients(wide), 2, F.col("Total_per_country").desc(), "state").collect()
    assert [(r.state, r.Total_per_country) for r in top] == [("Sonora", 6), ("Colima", 3)]


def test_latest_pivot_prefers_valid_flags_and_the_earliest_app(spark):
    f = spark.createDataFrame([
        ("10001", "android", "Introduccion", D(2024, 1, 1), 1),
        ("10001", "ios", "Firma", D(2024, 1, 2), 2),                      # invalid code
        ("10002", "zeta", "Firma", None, 2),                              # undated: last
        ("10002", None, "Introduccion", D(2024, 1, 1), None),             # no app
        ("10002", "ios", "Firma", D(2024, 1, 3), 2),
    ], FUNNEL)
    got = {r.client_id: (r.app, r.complete_process) for r in gold.client_stage_dates_latest(f, _catalog(spark)).collect()}
    assert got == {"10001": ("android", 1), "10002": ("ios", 2)}


def test_total_time_without_shuffle_on_unique_clients(spark):
    pv = _pv(spark)
    a = rp.total_time(pv)
    b = rp.total_time(pv, unique_clients=True)
    assert rows(a) == rows(b)
    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange")

    assert exchanges(b) < exchanges(a)
