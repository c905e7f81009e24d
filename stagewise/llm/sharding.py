"""Sharding by extendible hashing (op 7).

A shard is a prefix of hash bits. Starting from the empty prefix, only a bucket
over the byte limit is split on the next bit, until every shard fits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_materialized, materialize, text_or_empty

LIMIT = 16 << 20
STEP = 8  # bits by which the directory deepens where cells are still too large
WORD = 40  # bits taken from each of the three hashes


def _bits(x: Column) -> Column:
    return F.substring(F.lpad(F.bin(x), 64, "0"), 1, WORD)


def hashed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: Column | None = None) -> DataFrame:
    """``(doc_id, row, n_bytes, bits)`` of every row, written once.

    The bits are those of the id's hash, then of the text's, then of a row
    number, so rows of one id can be told apart by text and equal rows by number."""
    t = text_or_empty(text)
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    row = F.monotonically_increasing_id() if row is None else row
    d = docs.select(F.col(doc_id).alias("doc_id"), row.alias("row"), F.octet_length(t).cast("bigint").alias("n_bytes"),
                    F.concat(_bits(F.xxhash64(key)), _bits(F.xxhash64(t, F.lit(1))), _bits(F.xxhash64(row, F.lit(2)))).alias("bits"))
    return materialize(d, "hashed")


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``(shard, depth, shard_bytes)``: the local depth and size of every shard.

    Bytes are summed per cell (a prefix some bits longer than shards should
    need) with map-side combine; a shard is the shortest prefix that fits. Cells
    that don't fit themselves are deepened by STEP bits, and only their rows
    are read again. At the last bit a shard stays as it is: one row larger than
    the limit. The directory has a row for each shard, so it grows with the
    bytes, not with the rows."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(3 * WORD, max(0, math.ceil(math.log2(max(total, 1) / limit))) + 4)
    done, base, open_rows = None, 0, rows
    while True:
        cells = open_rows.groupBy(F.substring("bits", 1, depth).alias("cell")).agg(F.sum("n_bytes").alias("n"))
        cells = materialize(cells, "cells")
        sums = cells.select("n", F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("depth"), "cell")
        sums = sums.groupBy("depth", F.expr("substring(cell, 1, depth)").alias("shard")).agg(F.sum("n").alias("bytes"))
        sums = materialize(sums, "prefixes")
        fits = sums.where((F.col("bytes") <= limit) | (F.lit(depth) >= 3 * WORD) & (F.col("depth") == depth))
        wide = sums.where(F.col("bytes") > limit)
        parents = wide.select((F.col("depth") + 1).alias("depth"), F.col("shard").alias("parent"))
        # a prefix that fits is a shard if the prefix one bit shorter doesn't fit
        top = (F.col("depth") == base) & F.lit(base == 0)
        keyed = fits.withColumn("parent", F.expr("substring(shard, 1, depth - 1)"))
        inner = keyed.join(parents, ["depth", "parent"], "left_semi").select("shard", "depth", "bytes")
        found = keyed.where(top).select("shard", "depth", "bytes").unionByName(inner)
        done = found if done is None else done.unionByName(found)
        left = wide.where((F.col("depth") == depth) & F.lit(depth < 3 * WORD)).select(F.col("shard").alias("open"))
        drop_materialized(cells)
        if left.isEmpty():
            break
        at = depth
        open_rows = open_rows.join(left, F.substring("bits", 1, at) == F.col("open"), "left_semi")
        base, depth = at, min(3 * WORD, at + STEP)
    return done.select("shard", F.col("depth").cast("int").alias("depth"), F.col("bytes").alias("shard_bytes"))


def assign_shards(docs: DataFrame, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text",
                  row: Column | None = None) -> DataFrame:
    """``(doc_id, row, n_bytes, shard, depth, shard_bytes)`` for every row.

    A NULL id hashes as the empty string, a NULL text has no bytes. The shards
    are prefix-free, so each row has exactly one; a row looks its shard up by
    the prefixes of the depths in use, of which there are few."""
    rows = hashed(docs, doc_id, text, row)
    d = materialize(directory(rows, limit), "directory")
    depths = sorted(r["depth"] for r in d.select("depth").distinct().collect())
    names = F.array(*[F.substring("bits", 1, k) if k else F.lit("") for k in depths or [0]])
    keyed = rows.select("doc_id", "row", "n_bytes", F.explode(names).alias("shard"))
    return keyed.join(d, "shard").select("doc_id", "row", "n_bytes", "shard", "depth", "shard_bytes")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` as Parquet, one folder ``shard=<bits>`` for each shard (``_`` is the empty prefix)."""
    t = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    s = assign_shards(t, limit, doc_id, text, F.col("__row")).select(
        F.col("row").alias("__row"), F.concat(F.lit("_"), F.col("shard")).alias("shard"))
    t.join(s, "__row").drop("__row").repartition("shard").write.partitionBy("shard").parquet(path)
