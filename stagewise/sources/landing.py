"""Landing CSV drops (I1) and the load stamp."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import timestamp_value
from ..schemas import LOAD_TS_COLUMN, landing_schema


def landing_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}.csv"


def read_landing(spark: SparkSession, root: str, table: str,
                 columns: Sequence[str] | None = None, malformed: str | None = None) -> DataFrame:
    """Header CSV, every column text.

    With ``columns`` the all-string schema is given up front (no header
    inference job) and ``enforceSchema=false`` makes Spark check it
    against each file's header, so a file whose columns differ fails
    instead of binding values by position. A line with too few fields is
    filled up with NULLs and one with too many is cut; ``malformed`` names an
    extra column that holds the text of such lines (NULL for all others)."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if columns is not None:
        extra = () if malformed is None else (malformed,)
        r = r.schema(landing_schema((*columns, *extra))).option("enforceSchema", False)
    if malformed is not None:  # fields can only be counted if all of them are parsed
        r = r.option("columnNameOfCorruptRecord", malformed).option("columnPruning", False)
    return r.csv(landing_path(root, table))


def write_landing(df: DataFrame, root: str, table: str) -> str:
    """Drop ``df`` as a header CSV (all values as text) into the landing area."""
    path = landing_path(root, table)
    df.select([F.col(c).cast("string").alias(c) for c in df.columns]) \
      .write.mode("errorifexists").option("header", True).csv(path)
    return path


def with_load_ts(df: DataFrame, name: str = LOAD_TS_COLUMN,
                 ts: Column | str | _dt.datetime | None = None) -> DataFrame:
    """Stamp every row with the load time (``None``: current_timestamp();
    pass one literal per batch for replayable loads)."""
    return df.withColumn(name, timestamp_value(ts))
