"""Funnel reports against a plain-Python model on random per-client rows."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stagewise.operators import funnel as fn
from stagewise.schemas import STAGE_CODES, STAGE_COLUMNS

D = dt.date(2024, 1, 1)
ROW = st.tuples(
    st.sampled_from(["A", "B", None]),
    st.sampled_from([0, 1, 2]),
    st.lists(st.booleans(), min_size=6, max_size=6),
)
SCHEMA = "state string, complete_process int, " + ", ".join(f"{c} date" for c in STAGE_COLUMNS)


def _rows(raw):
    return [(s, cp, *[D if present else None for present in flags]) for s, cp, flags in raw]


def model_reached(raw):
    out = []
    for i in range(6):
        out.append(len(raw) if i == 0 else sum(1 for _, _, f in raw if any(f[i:])))
    return out


def model_abandon(raw):
    counts = [0] * 6
    for _, cp, f in raw:
        if cp != 0:
            continue
        last = max([i for i in range(1, 6) if f[i]], default=0)
        counts[last] += 1
    return counts


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(raw=st.lists(ROW, max_size=12))
def test_reports_match_model(spark, raw):
    pv = spark.createDataFrame(_rows(raw), SCHEMA)
    g = fn.reached(pv).first()
    assert [g[c] for c in STAGE_CODES] == model_reached(raw)
    a = fn.abandonment(pv).first()
    assert [a[c] for c in STAGE_CODES] == model_abandon(raw)
    conv = {r.stage: r.Percentage_conversion for r in fn.conversion_global(pv).collect()}
    want = model_reached(raw)
    for code, n in zip(STAGE_CODES, want):
        assert conv[code] == (round(n * 100.0 / want[0], 2) if want[0] else None)
    per_state = {(r.state, r.stage): r.Total_users for r in fn.conversion_per_state(pv).collect()}
    for state in {s for s, _, _ in raw if s is not None}:
        sub = [r for r in raw if r[0] == state]
        for code, n in zip(STAGE_CODES, model_reached(sub)):
            assert per_state[(state, code)] == n
    assert all(s is not None for s, _ in per_state)
