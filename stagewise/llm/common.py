"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_materialized, materialize, ship_package

__all__ = ["read_table", "text_or_empty", "text_key", "materialize", "drop_materialized", "ship_package", "connected_components"]

#: tiktoken's word pattern backs over a run of blanks on its stack; texts with longer runs go to ``tokenizers``.
LONG_BLANKS = re.compile(r"\s{1000}")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    """The text, with NULL read as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def text_key(col: str | Column) -> Column:
    """16-byte key of a whole text: equal texts, and only they (up to md5), share it."""
    return F.unhex(F.md5(text_or_empty(col)))


def connected_components(links: DataFrame) -> DataFrame:
    """Smallest node of each linked node's component: rows ``(node, root)`` of
    every node that is in ``links(a, b)``.

    Alternating large-star and small-star steps; every step is a grouped
    minimum (combined before the shuffle) joined back to the links, so a hub
    with very many links is split by AQE's skew join and no group is collected.
    Each round is written to the shared scratch folder, which cuts the lineage
    and survives lost executors. ``links`` may be empty.
    """
    cur = materialize(_oriented(links), "links")
    seen = _checksum(cur)
    while True:
        nxt = materialize(_small_star(_large_star(cur)), "links")
        now = _checksum(nxt)
        drop_materialized(cur)
        cur = nxt
        if now == seen:
            break
        seen = now
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots).distinct()


def _oriented(links: DataFrame) -> DataFrame:
    return (
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b")).distinct()
    )


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    e = _oriented(e)
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    others = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
    return _oriented(others.unionByName(low.select("a", F.col("m").alias("b"))))


def _checksum(e: DataFrame) -> tuple:
    """Row count and order-free checksum of the link set."""
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]
