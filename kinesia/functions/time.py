"""Time ticks and buckets."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinesia.schema import TICKS_PER_SECOND


def bucket_width(imu_freq_hz: float, hr_freq_hz: float) -> int:
    """Samples of the fast sensor per sample of the slow one, rounded half-up.

    100 Hz over 9 Hz gives 11. Python's ``round`` is half-even, so it is not used.
    """
    if hr_freq_hz <= 0 or imu_freq_hz <= 0:
        raise ValueError("frequencies must be positive")
    return int(math.floor(imu_freq_hz / hr_freq_hz + 0.5))


def time_tick(seconds: str | Column, per_second: int = TICKS_PER_SECOND) -> Column:
    """Seconds (double) to integer ticks: ``round(seconds * 100)`` half-up, 64-bit."""
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.round(col * F.lit(per_second), 0).cast(T.LongType())


def bucket_index(tick: str | Column, width: int) -> Column:
    """Bucket number ``int(tick / width)``, truncated toward zero as the reference did."""
    if width <= 0:
        raise ValueError("bucket width must be positive")
    col = F.col(tick) if isinstance(tick, str) else tick
    return (col / F.lit(width)).cast(T.LongType())
