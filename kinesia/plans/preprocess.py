"""Preprocessing job (J1): raw readings -> per-bucket means ready for training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kinesia.functions.time import bucket_width
from kinesia.operators.aggregate import bucketed_mean
from kinesia.operators.filters import drop_empty_rows
from kinesia.operators.projections import with_magnitudes
from kinesia.schema import BUCKET_TIME_TYPE, HR_FREQ_HZ, IMU_FREQ_HZ, KEY_COLUMNS, MISSING


def preprocess(
    raw: DataFrame,
    *,
    bucket_ticks: int | None = None,
    imu_freq_hz: float = IMU_FREQ_HZ,
    hr_freq_hz: float = HR_FREQ_HZ,
    sentinel: str = MISSING,
    ordered: bool = True,
    time_type: T.DataType = BUCKET_TIME_TYPE,
    exact_magnitudes: bool = True,
) -> DataFrame:
    """Clean, reduce and bucket raw sensor rows.

    ``raw`` has the raw CSV's columns (text measurements with the sentinel).
    The bucket is ``bucket_ticks`` hundredths of a second wide; by default the
    number of IMU samples per heart-rate sample, round(100 / 9) = 11. The bucket
    time is ``decimal(10,2)`` seconds unless ``time_type`` says otherwise.
    ``exact_magnitudes=False`` trades the exact decimal squares for double
    arithmetic (see ``functions.magnitude``), the per-row hot spot at scale.

    Plan: scan -> filter -> one projection (magnitudes) -> partial aggregate ->
    hash shuffle on (user, activity, bucket) -> final aggregate -> filter ->
    optional range-partitioned sort. Two shuffles at most, no driver round trip,
    no per-key jobs; the grouping key is fine-grained, so a user or activity
    holding a third of the rows still spreads over many buckets and tasks.
    """
    width = bucket_ticks if bucket_ticks is not None else bucket_width(imu_freq_hz, hr_freq_hz)
    kept = drop_empty_rows(raw, KEY_COLUMNS, sentinel)
    reduced = with_magnitudes(kept, sentinel=sentinel, exact=exact_magnitudes)
    out = bucketed_mean(reduced, width, time_type=time_type)
    if ordered:
        out = out.orderBy("timestamp", "user_id", "activity_id")
    return out
