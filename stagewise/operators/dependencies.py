"""Functional dependencies of a table, with the rows that break them counted (the catalog's assumptions, checked).

The per-client reports assume that a client's attributes depend on its id. ``dependencies`` finds every minimal rule
``lhs -> rhs`` that holds up to a share of rows, and ``violating_keys`` lists where a rule fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_materialized, materialize

Rule = tuple[tuple[str, ...], str]


def _key(columns: Sequence[str]) -> Column:
    """The values of some columns as one text; NULL is a value like any other."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})


def _violations(distinct: DataFrame, rules: Sequence[Rule]) -> dict[Rule, int]:
    """For each rule, how many rows have to go for it to hold: all but the commonest right-hand value of each left-hand group.

    One job for all rules of a level: each distinct row is read once, gives a key pair a rule, and is counted
    before the shuffle. Groups of one right-hand value, most of them, hold no violation."""
    each = [F.struct(F.lit(i).alias("rule"), _key(lhs).alias("lhs"), _key([rhs]).alias("rhs")) for i, (lhs, rhs) in enumerate(rules)]
    pairs = distinct.select("n", F.inline(F.array(*each))).groupBy("rule", "lhs", "rhs").agg(F.sum("n").alias("n"))
    groups = pairs.groupBy("rule", "lhs").agg((F.sum("n") - F.max("n")).alias("bad")).where("bad > 0")
    bad = {r["rule"]: r["bad"] for r in groups.groupBy("rule").agg(F.sum("bad").alias("bad")).collect()}  # a row a rule
    return {rule: bad.get(i, 0) for i, rule in enumerate(rules)}


def dependencies(df: DataFrame, columns: Sequence[str], max_lhs: int = 3, max_error: float = 0.0) -> DataFrame:
    """All minimal rules with up to ``max_lhs`` left-hand columns: ``lhs`` (names joined by commas, in the order of ``columns``), ``rhs``,
    ``violations`` (rows that break it) and ``error`` (their share, at most ``max_error``).

    A rule is minimal if none with fewer of its left-hand columns is good enough; the search goes up the levels
    and leaves such supersets out. The table is reduced to its distinct rows with counts first. NULLs equal NULLs."""
    spark, columns = df.sparkSession, list(columns)
    distinct = materialize(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), "distinct")
    total = distinct.agg(F.sum("n")).first()[0] or 0
    found: dict[Rule, int] = {}
    for size in range(1, max_lhs + 1):
        rules = [(lhs, rhs) for rhs in columns for lhs in combinations([c for c in columns if c != rhs], size)
                 if not any(r == rhs and set(x) <= set(lhs) for x, r in found)]
        if not rules or not total:
            break
        found |= {rule: bad for rule, bad in _violations(distinct, rules).items() if bad <= max_error * total}
    drop_materialized(distinct)
    rows = [(",".join(lhs), rhs, bad, bad / total) for (lhs, rhs), bad in found.items()]
    return spark.createDataFrame(rows, "lhs string, rhs string, violations bigint, error double")


def violating_keys(df: DataFrame, lhs: Sequence[str], rhs: str) -> DataFrame:
    """The left-hand groups that break ``lhs -> rhs``: ``lhs``, ``values`` (different right-hand ones, NULL included),
    ``rows`` and ``violations`` (rows without the commonest value)."""
    counts = df.groupBy(*lhs, rhs).agg(F.count(F.lit(1)).alias("n"))
    groups = counts.groupBy(*lhs).agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows"), (F.sum("n") - F.max("n")).alias("violations"))
    return groups.where("values > 1")
