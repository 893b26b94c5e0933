"""Event-time bucketing on a stream.

The batch bucket ``int(round(t * 100) / width)`` equals an epoch-aligned
tumbling window of ``width * 10`` ms over ``t`` rounded to 10 ms, so the
streaming form uses Spark's ``window`` with a watermark: state per open
(user, activity, window) only, evicted once the watermark passes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinesia.functions.time import time_tick
from kinesia.schema import BUCKET_TIME_TYPE, FEATURES, OUTPUT_COLUMNS, TICKS_PER_SECOND

EVENT_TIME = "_event_time"


def event_time(seconds: str | Column, ticks_per_second: int = TICKS_PER_SECOND) -> Column:
    """Seconds rounded to ticks, as a TIMESTAMP (what watermarks and windows need)."""
    return F.timestamp_micros(time_tick(seconds, ticks_per_second) * F.lit(1_000_000 // ticks_per_second))


def stream_bucketed_mean(
    df: DataFrame,
    width: int,
    *,
    watermark: str,
    keys: Sequence[str] = ("user_id", "activity_id"),
    time_col: str = "timestamp",
    measures: Sequence[str] = FEATURES,
    output: Sequence[str] = OUTPUT_COLUMNS,
    ticks_per_second: int = TICKS_PER_SECOND,
    with_bucket: bool = False,
    time_type: T.DataType = BUCKET_TIME_TYPE,
) -> DataFrame:
    """Streaming twin of ``bucketed_mean``: same rows for every closed bucket.

    ``watermark`` is how late a reading may come; later ones are dropped, so there is no
    default (``streaming.late`` keeps them).

    ``with_bucket`` adds the bucket number (window start / width), the key that
    identifies a row across update-mode emissions.
    """
    width_ms = width * (1000 // ticks_per_second)
    duration = f"{width_ms} milliseconds"
    timed = df.withColumn(EVENT_TIME, event_time(time_col, ticks_per_second)).withWatermark(EVENT_TIME, watermark)
    for k in keys:
        timed = timed.where(F.col(k).isNotNull())
    grouped = timed.groupBy(*keys, F.window(EVENT_TIME, duration).alias("_window")).agg(
        F.avg(time_col).alias(time_col),
        *[F.avg(m).alias(m) for m in measures],
    )
    complete = grouped.na.drop(how="any", subset=list(output))
    kept = complete.withColumn(time_col, F.col(time_col).try_cast(time_type))
    if not with_bucket:
        return kept.select(*output)
    bucket = (F.unix_millis(F.col("_window.start")) / F.lit(width_ms)).cast("bigint").alias("bucket")
    return kept.select(*output, bucket)
