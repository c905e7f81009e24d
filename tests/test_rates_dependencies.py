"""Rates against exact sums of the binomial distribution; dependencies against brute force."""

import random
from fractions import Fraction
from itertools import combinations
from math import comb

import pytest

from stagewise.operators import dependencies as dp
from stagewise.operators import rates


def _tail(k, n, p):
    p = Fraction(p)
    return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k, n + 1))


def test_tails_and_intervals_equal_exact_sums():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 60)
        k, p = rng.randint(0, n), rng.randint(1, 99) / 100
        assert rates.at_least(k, n, p) == pytest.approx(float(_tail(k, n, p)), abs=1e-12)
        low, high = rates.interval(k, n)
        assert low <= k / n <= high
        assert low == 0 if k == 0 else float(_tail(k, n, low)) == pytest.approx(0.025, abs=1e-9)
        assert high == 1 if k == n else float(1 - _tail(k + 1, n, high)) == pytest.approx(0.025, abs=1e-9)
    low, high = rates.interval(10**9 // 3, 10**9)          # the work doesn't grow with the counts
    assert 0.33330 < low < 1 / 3 < high < 0.33337
    assert rates.two_sided(5, 10, 0.5) == 1.0


def test_flags_equal_the_step_up_rule(spark):
    rng = random.Random(3)
    rows = [(f"g{i}", n, sum(rng.random() < (0.5 if i % 4 else 0.8) for _ in range(n))) for i, n in enumerate(rng.choices(range(0, 120), k=60))]
    df = spark.createDataFrame(rows + [(None, 30, 29), ("split", 20, 1), ("split", 20, 2)], "state string, TI long, TCD long").repartition(4)
    groups = {}
    for g, n, k in [*rows, (None, 30, 29), ("split", 40, 3)]:
        if n:
            groups[g] = (n, k)
    p = sum(k for _, k in groups.values()) / sum(n for n, _ in groups.values())
    values = sorted((rates.two_sided(k, n, p), str(g)) for g, (n, k) in groups.items())
    limit = max((v for i, (v, _) in enumerate(values, 1) if v <= 0.05 * i / len(values)), default=-1)
    got = rates.differing_groups(df, ["state"], "TCD", "TI").collect()
    assert {str(r.state): (r.n, r.k) for r in got} == {str(g): x for g, x in groups.items()}
    assert {str(r.state) for r in got if r.flagged} == {g for v, g in values if v <= limit}
    assert 5 < sum(r.flagged for r in got) < len(got)
    for r in got:
        assert r.rank == sum(v <= r.p_value for v, _ in values) and (r.low, r.high) == rates.interval(r.k, r.n)
    assert rates.differing_groups(df.limit(0), ["state"], "TCD", "TI").collect() == []


def test_false_flags_among_equal_groups_are_rare(spark):
    rng = random.Random(8)
    rows = [(f"g{i}", 200, sum(rng.random() < 0.3 for _ in range(200))) for i in range(200)]
    got = rates.differing_groups(spark.createDataFrame(rows, "state string, TI long, TCD long"), ["state"], "TCD", "TI").collect()
    assert sum(r.p_value < 0.05 for r in got) > 0 and sum(r.flagged for r in got) == 0


COLS = ["a", "b", "c", "d", "e"]


def _table(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(120):
        a, b, c = rng.randrange(6), rng.choice([0, 1, None]), rng.randrange(3)
        rows.append((a, b, c, a % 3 if rng.random() > 0.03 else 7, (a + (b or 0) + c) % 4))
    return rows + rows[:30]


def _bad(rows, lhs, rhs):
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[COLS.index(c)] for c in lhs), []).append(r[COLS.index(rhs)])
    return sum(len(v) - max(v.count(x) for x in v) for v in groups.values())


@pytest.mark.parametrize("seed,error", [(1, 0.0), (2, 0.05), (3, 0.3)])
def test_minimal_rules_up_to_three_equal_brute_force(spark, seed, error):
    rows = _table(seed)
    want = {}
    for rhs in COLS:
        for size in (1, 2, 3):
            for lhs in combinations([c for c in COLS if c != rhs], size):
                if _bad(rows, lhs, rhs) <= error * len(rows) and not any(r == rhs and set(x) <= set(lhs) for x, r in want):
                    want[lhs, rhs] = _bad(rows, lhs, rhs)
    got = dp.dependencies(spark.createDataFrame(rows, ", ".join(f"{c} int" for c in COLS)), COLS, 3, error).collect()
    assert {(tuple(r.lhs.split(",")), r.rhs): r.violations for r in got} == want and want
    assert all(r.error == r.violations / len(rows) for r in got)


def test_violating_keys(spark):
    df = spark.createDataFrame([("x", "A"), ("x", "A"), ("x", None), ("y", "B"), (None, "A"), (None, "B")], "k string, v string")
    got = {r.k: (r["values"], r["rows"], r.violations) for r in dp.violating_keys(df, ["k"], "v").collect()}
    assert got == {"x": (2, 3, 1), None: (2, 2, 1)}
    assert dp.dependencies(df.limit(0), ["k", "v"]).collect() == []
