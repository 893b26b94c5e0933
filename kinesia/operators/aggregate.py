"""Aggregations.

All of them are one ``groupBy().agg()``: Spark plans a partial (map-side)
aggregate, one hash shuffle on the grouping key and a final aggregate. The
reference's driver loop over user/activity keys (collect keys, filter, group,
union) is replaced by grouping on those keys directly, so there is one job
whatever the number of keys, no key list on the driver and no union fan-in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinesia.functions.time import bucket_index, time_tick
from kinesia.schema import BUCKET_TIME_TYPE, FEATURES, OUTPUT_COLUMNS, TICKS_PER_SECOND

_AGGREGATES = {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min}


def multi_agg(
    df: DataFrame,
    group: Sequence[str | Column],
    how: str = "avg",
    carry: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Aggregate every non-group column with ``avg|sum|max|min`` (A1-A3).

    ``carry`` columns are constant within a group in the reference's use and
    were taken with ``first``; here they are taken with ``min``, which is
    deterministic, so a re-run task after an executor loss gives the same row
    (A4). Output columns keep their input names.
    """
    if how not in _AGGREGATES:
        raise ValueError(f"unknown aggregate {how!r}; use one of {sorted(_AGGREGATES)}")
    fn = _AGGREGATES[how]
    group_names = {g for g in group if isinstance(g, str)}
    carry_set = set(carry)
    measured = list(columns) if columns is not None else [
        c for c in df.columns if c not in group_names and c not in carry_set
    ]
    aggs = [fn(c).alias(c) for c in measured] + [F.min(c).alias(c) for c in carry]
    return df.groupBy(*group).agg(*aggs)


def bucketed_mean(
    df: DataFrame,
    width: int,
    *,
    keys: Sequence[str] = ("user_id", "activity_id"),
    time_col: str = "timestamp",
    measures: Sequence[str] = FEATURES,
    output: Sequence[str] = OUTPUT_COLUMNS,
    ticks_per_second: int = TICKS_PER_SECOND,
    time_type: T.DataType = BUCKET_TIME_TYPE,
    tick_col: str | None = None,
) -> DataFrame:
    """Per key and time bucket, the mean of time and of every measure.

    bucket = int(round(t * 100) / width). Rows with a NULL key are dropped (the
    reference crashed on them). A bucket survives only if no output column is
    NULL, i.e. every measure has at least one reading in it (F4). The bucket
    time is the mean over all its rows, then cast to ``time_type``
    (``decimal(10,2)`` as in the reference, which holds up to 10^8 s; pass a
    wider type for epoch timestamps). As in the reference the cast comes after
    the NULL test, so an overflowing time gives a NULL time, not a lost bucket.
    ``tick_col`` names an integer tick column already in the frame (the
    reference's ``ts``); by default the tick is derived from ``time_col``.
    """
    tick = F.col(tick_col) if tick_col else time_tick(time_col, ticks_per_second)
    bucket = bucket_index(tick, width)
    keyed = df
    for k in keys:
        keyed = keyed.where(F.col(k).isNotNull())
    grouped = keyed.groupBy(*keys, bucket.alias("_bucket")).agg(
        F.avg(time_col).alias(time_col),
        *[F.avg(m).alias(m) for m in measures],
    )
    complete = grouped.na.drop(how="any", subset=list(output))
    return complete.withColumn(time_col, F.col(time_col).try_cast(time_type)).select(*output)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct combinations of ``cols`` (A7); a partial + final hash aggregate."""
    return df.select(*cols).distinct()


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """Row count as a one-row frame (A8), computed with partial counts per task."""
    return df.agg(F.count(F.lit(1)).alias(name))
