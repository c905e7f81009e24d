"""Layer tables (I3-I7): one Parquet folder, partitioned by a hash bucket of the key.

    <root>/sw_bucket=<k>/part-*.parquet

A MERGE reads and overwrites only the buckets that its source's keys fall into
(dynamic partition overwrite); an insert-only MERGE appends to them. The number
of buckets and the bucket columns belong to the table and are given by the
caller on every call. Replacing several buckets is not atomic: a run that dies
half-way leaves old and new buckets side by side, and running the same drop
again repairs that, since a MERGE of rows already merged changes nothing. One
writer per table is assumed. A source row with a NULL key never matches; such
rows are spread over the buckets by their whole content.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.merge import Insert, NullKeyError, Update, dedupe_latest, merge, merge_inserts
from ..session import drop_materialized, materialize

BUCKET = "sw_bucket"
BUCKETS = 16


def bucket_expr(keys: Sequence[str], buckets: int, columns: Sequence[str] = (), among: Sequence[int] | None = None) -> Column:
    """Bucket of a row by its key; of a row with a NULL in its key by all ``columns``, one of ``among`` if given."""
    by_key = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    by_row = F.xxhash64(*[F.col(c) for c in columns or keys])
    if among is None:
        anywhere = F.pmod(by_row, F.lit(buckets)).cast("int")
    else:
        anywhere = F.get(F.array(*[F.lit(k) for k in among]), F.pmod(by_row, F.lit(len(among))).cast("int"))
    return F.when(null, anywhere).otherwise(by_key)


def table_exists(spark: SparkSession, root: str) -> bool:
    """There is a readable table at ``root``."""
    try:
        spark.read.parquet(root)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def read_table(spark: SparkSession, root: str, schema: StructType | None = None,
               buckets: Iterable[int] | None = None) -> DataFrame:
    """The table, or those of its ``buckets`` only (pruned before the scan).
    Passing the layer's known ``schema`` skips the footer-reading job of inference."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(StructType(schema.fields + [StructField(BUCKET, IntegerType(), True)]))
    t = reader.parquet(root)
    if buckets is not None:
        t = t.where(F.col(BUCKET).isin(list(buckets)))
    return t.drop(BUCKET)


def _write(df: DataFrame, root: str, mode: str, overwrite: str = "static") -> None:
    """Write rows with their bucket. The rebalance hint gives each bucket few
    files and lets AQE split a hot bucket over several tasks."""
    (df.hint("rebalance", BUCKET).write.mode(mode).option("partitionOverwriteMode", overwrite)
       .partitionBy(BUCKET).parquet(root))


def ensure_table(spark: SparkSession, root: str, schema: StructType) -> bool:
    """Create an empty table with ``schema`` if none exists (create-if-
    absent, so a re-run does not fail). Returns True when created."""
    if table_exists(spark, root):
        return False
    # a file without rows in the first bucket carries the schema
    spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(f"{root}/{BUCKET}=0")
    return True


def publish(df: DataFrame, root: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """I4: write ``df`` as the whole table."""
    _write(df.withColumn(BUCKET, bucket_expr(keys, buckets, df.columns)), root, "overwrite")
    ensure_table(df.sparkSession, root, df.schema)


def touched_buckets(staged: DataFrame) -> list[int]:
    """Buckets that occur in a staged source (at most the table's number of buckets)."""
    return sorted(r[0] for r in staged.select(BUCKET).distinct().collect())


def merge_into(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    on: Sequence[str],
    when_matched: Update | None = None,
    when_not_matched: Insert | None = Insert(),
    schema: StructType | None = None,
    buckets: int = BUCKETS,
    bucket_by: Sequence[str] | None = None,
    touched: Sequence[int] | None = None,
    **kw,
) -> None:
    """MERGE ``source`` into the table at ``root``, bucketed by ``bucket_by``
    (some of ``on``; default all of it). ``touched``: the buckets of the source's
    rows, or more than those, where they are known (they are counted otherwise).

    The source is written once to the shared scratch folder, so every pass
    reads the same rows; it is removed whether the merge succeeds or not. A
    source that already has the table's bucket column is taken to be written (a
    staged drop) and is left to its owner."""
    if when_matched is None and when_not_matched is None:
        return
    keys = list(bucket_by or on)
    own = None
    if BUCKET in source.columns:
        staged = source
    else:
        staged = own = materialize(source.withColumn(BUCKET, bucket_expr(keys, buckets, source.columns)), "merge-source")
    try:
        touched = touched_buckets(staged) if touched is None else list(touched)
        if not touched:
            return
        target, source = read_table(spark, root, schema, touched), staged.drop(BUCKET)
        if when_matched is None:
            out, mode, among = merge_inserts(target, source, on, when_not_matched, **kw), "append", None
        else:
            out = merge(target, source, on, when_matched, when_not_matched, materialize_source=False, **kw)
            # rows with a NULL key may go anywhere, but only into buckets whose rows are all in ``out``
            mode, among = "overwrite", touched
        _write(out.withColumn(BUCKET, bucket_expr(keys, buckets, out.columns, among)), root, mode, "dynamic")
    finally:
        drop_materialized(own)


def create_or_merge(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    on: Sequence[str],
    when_matched: Update | None = Update(),
    when_not_matched: Insert | None = Insert(),
    buckets: int = BUCKETS,
    bucket_by: Sequence[str] | None = None,
    dedupe_by: str | None = None,
    touched: Sequence[int] | None = None,
    **kw,
) -> None:
    """First load creates the table from ``source``; later loads MERGE
    (default update-all / insert-all, M1) into a table of the source's schema.

    ``dedupe_by`` keeps one source row per key, the one with the greatest
    value of that column (``dedupe_latest``; T7: by default duplicate keys in a
    first load are kept, and a later updating MERGE then raises)."""
    if dedupe_by is not None:
        source = dedupe_latest(source.drop(BUCKET), on, dedupe_by)
    if table_exists(spark, root):
        merge_into(spark, root, source, on, when_matched, when_not_matched, source.drop(BUCKET).schema, buckets, bucket_by, touched, **kw)
        return
    source = source.drop(BUCKET)
    null_keys = kw.get("null_keys", "insert")
    if null_keys != "insert":
        nullk = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
        if null_keys == "error" and source.filter(nullk).limit(1).count():
            raise NullKeyError(f"source has rows with a NULL key in {list(on)}")
        source = source.filter(~nullk)
    publish(source, root, list(bucket_by or on), buckets)
