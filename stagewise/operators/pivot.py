"""Stage pivot (A1) and stage-label mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import map_values
from ..schemas import STAGE_COLUMNS, STAGE_LABEL_TO_COLUMN

_AGGS = {"min": F.min, "max": F.max}


def map_stage(df: DataFrame, col: str = "stage", mapping: Mapping[str, str] = STAGE_LABEL_TO_COLUMN,
              default: str | Column | None = None) -> DataFrame:
    """Source labels -> pivot column names; unknown or NULL -> NULL."""
    return df.withColumn(col, map_values(col, mapping, default))


def pivot_stages(
    df: DataFrame,
    keys: Sequence[str | Column],
    stage: str = "stage",
    stages: Sequence[str] = STAGE_COLUMNS,
    value: str = "register_date",
    agg: str = "min",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """A1: one row per ``keys`` group, one ``agg(value)`` column per listed
    stage. Rows whose stage is not listed add no date, but their group
    still yields a row (with NULL dates).

    Written as conditional aggregates (``min(CASE WHEN stage = s THEN value
    END)``) rather than ``GroupedData.pivot``: it is the same result with
    a single partial + final HashAggregate around one exchange, where
    ``pivot`` plans two aggregations (keys+stage, then PivotFirst).
    ``extra`` adds further aggregate columns to the same pass.
    """
    fn = _AGGS[agg]
    s = F.col(stage)
    cols = [fn(F.when(s == name, F.col(value))).alias(name) for name in stages]
    return df.groupBy(*keys).agg(*cols, *extra)
