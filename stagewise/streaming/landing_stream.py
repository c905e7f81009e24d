"""Incremental pickup of landing drops with Structured Streaming.

The source system re-runs its landing -> bronze load on a schedule and
MERGEs whatever file is there. Here the landing folder of one table is a
file stream: each new CSV drop is processed exactly once (the stream's
checkpoint records which files were consumed), stamped, and merged into
the bronze table by ``create_or_merge`` inside ``foreachBatch``. With
``trigger(availableNow=True)`` a scheduled job drains every pending drop
and stops, so it replaces the external scheduler without a long-running
service. A replayed micro-batch (after a lost executor or driver) merges
the same rows again, which an update-all / insert-all MERGE absorbs.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..schemas import LOAD_TS_COLUMN, landing_schema
from ..sources.landing import with_load_ts
from ..sources.tables import BUCKETS, create_or_merge


def _now(_batch_id: int) -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def landing_stream(
    spark: SparkSession,
    drops_dir: str,
    columns: Sequence[str],
    bronze_root: str,
    keys: Sequence[str],
    checkpoint: str,
    stamp: Callable[[int], str] = _now,
    files_per_batch: int | None = None,
    on_loaded: Callable[[DataFrame, int], None] | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Start draining CSV drops under ``drops_dir`` into ``bronze_root``.

    All files that are there form one MERGE, however many a drop has; if two
    drops of the same keys wait at once, that MERGE is ambiguous and raises,
    and ``files_per_batch=1`` then takes single-file drops in arrival order;
    ``stamp(batch_id)`` gives the load timestamp of a micro-batch and
    ``on_loaded`` runs after each merge (e.g. the silver/gold steps);
    ``buckets`` is the bronze table's number of hash buckets of the first key."""
    reader = (spark.readStream.schema(landing_schema(tuple(columns)))
              .option("header", True).option("enforceSchema", False))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    drops = reader.csv(drops_dir)

    def load(batch: DataFrame, batch_id: int) -> None:
        src = with_load_ts(batch, LOAD_TS_COLUMN, stamp(batch_id))
        create_or_merge(batch.sparkSession, bronze_root, src, list(keys), buckets=buckets, bucket_by=[keys[0]])
        if on_loaded is not None:
            on_loaded(batch, batch_id)

    return (drops.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
