"""Ordered funnels and frequent paths against plain-Python models."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from stagewise.operators import paths
from stagewise.schemas import STAGES

LABELS = [s.label for s in STAGES]
CODES = [s.code for s in STAGES]
DAY = dt.date(2024, 1, 1)


def _events(seed=4, clients=60):
    rng = random.Random(seed)
    rows = []
    for c in range(clients):
        for _ in range(rng.randrange(0, 14)):
            day = None if rng.random() < 0.05 else DAY + dt.timedelta(rng.randrange(40))
            rows.append((str(c), "ns"[c % 2], rng.choice([*LABELS, *LABELS[:2], "Otro", None]), day))
    return rows + rows[:20] + [(None, "n", LABELS[0], DAY), (None, "n", LABELS[1], DAY)]


def _paths(rows):
    out = {}
    for c, _, label, day in rows:
        if label in LABELS and day is not None:
            out.setdefault(c, set()).add((day, LABELS.index(label)))
    return {c: sorted(p) for c, p in out.items()}


def _depth(path, within):
    """Tries every start; the earliest next stage is never worse."""
    best = 0
    for d0 in {d for d, i in path if i == 0}:
        at, depth = (d0, 0), 1
        while depth < len(LABELS):
            following = [e for e in path if e[1] == depth and e > at and (within is None or (e[0] - d0).days <= within)]
            if not following:
                break
            at, depth = min(following), depth + 1
        best = max(best, depth)
    return best


@pytest.mark.parametrize("within", [None, 0, 7, 20])
def test_ordered_funnel_equals_every_start_tried(spark, within):
    rows = _events()
    df = spark.createDataFrame(rows, "client_id string, state string, stage string, register_date date").repartition(3)
    depths = {c: _depth(p, within) for c, p in _paths(rows).items()}
    got = paths.ordered_funnel(df, within).first().asDict()
    assert got == {code: sum(d > i for d in depths.values()) for i, code in enumerate(CODES)}
    states = {r.state: r.TSD for r in paths.ordered_funnel(df, within, ["state"]).collect()}
    assert sum(states.values()) == got["TSD"]


def test_ordered_funnel_restarts_and_keeps_to_its_days(spark):
    """A first run that is too slow doesn't hide a later one, and a re-entry doesn't undo what was reached."""
    def days(*steps):
        return [("c", LABELS[i], DAY + dt.timedelta(d)) for i, d in steps]

    def depth(rows, within=10):
        df = spark.createDataFrame(rows, "client_id string, stage string, register_date date")
        return sum(paths.ordered_funnel(df, within).first())

    assert depth(days((0, 0), (1, 30), (0, 40), (1, 45))) == 2
    assert depth(days((0, 0), (1, 5), (0, 8), (2, 9))) == 3      # the run of day 0 goes on
    assert depth(days((0, 0), (0, 8), (1, 12), (2, 18))) == 3    # the run of day 8 is within 10 days
    assert depth(days((1, 0), (0, 1))) == 1                      # strict order
    assert depth(days((0, 0), (2, 1))) == 1                      # no stage is skipped
    assert depth(days((0, 3), (1, 3), (2, 3))) == 3              # one day, in funnel order
    assert paths.ordered_funnel(spark.createDataFrame([], "client_id string, stage string, register_date date")).first().TI == 0


@pytest.mark.parametrize("support,length", [(0.2, None), (0.05, 3), (1.0, None)])
def test_frequent_paths_equal_brute_force(spark, support, length):
    rows = _events(9, 40)
    df = spark.createDataFrame(rows, "client_id string, state string, stage string, register_date date").repartition(3)
    seqs = [[i for _, i in p] for p in _paths(rows).values()]
    counts = {}
    for s in seqs:
        for path in {c for n in range(1, min(len(s), length or 6) + 1) for c in itertools.combinations(s, n)}:
            counts[path] = counts.get(path, 0) + 1
    top = length or 6
    want = {">".join(CODES[i] for i in p): n for p, n in counts.items() if n >= support * len(seqs)}
    assert not want or max(p.count(">") + 1 for p in want) < 6 or length  # the model's own limit isn't met
    got = paths.frequent_paths(df, support, length).collect()
    assert {r.path: r.clients for r in got if r.length <= top} == want
    assert all(r.length == r.path.count(">") + 1 and r.support == r.clients / len(seqs) for r in got)


def test_frequent_paths_on_nothing(spark):
    df = spark.createDataFrame([("a", "Otro", DAY), ("b", LABELS[0], None)], "client_id string, stage string, register_date date")
    assert paths.frequent_paths(df, 0.1).collect() == []
    with pytest.raises(ValueError):
        paths.frequent_paths(df, 0)


def test_a_client_with_very_many_rows_is_reduced_before_the_shuffle(spark):
    """Its array holds one element a stage and day; the rest goes in the map-side phase."""
    df = spark.range(200_000).selectExpr("'hot' AS client_id", f"element_at(array({', '.join(repr(x) for x in LABELS)}), CAST(id % 6 + 1 AS INT)) AS stage",
                                         "date_add(DATE'2024-01-01', CAST(id % 50 AS INT)) AS register_date").repartition(8)
    out = paths.client_paths(df)
    assert out.select(F.size("path")).first()[0] <= 300
    assert "partial_collect_set" in out._jdf.queryExecution().executedPlan().toString()
