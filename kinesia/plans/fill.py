"""Preprocessing by forward fill: every reading kept, its missing values carried forward.

The other way to rows without gaps beside bucket means: rows stay at the sensors' own
rate, and the slow heart rate is repeated until its next reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinesia.operators.fill import forward_fill
from kinesia.operators.filters import drop_empty_rows, drop_incomplete
from kinesia.operators.projections import with_magnitudes
from kinesia.schema import FEATURES, KEY_COLUMNS, MISSING, OUTPUT_COLUMNS
from kinesia.session import shared_dir
from kinesia.sinks.files import write_outputs
from kinesia.sources.parquet import read_parquet


def fill_readings(
    raw: DataFrame,
    *,
    max_age: float | None = None,
    segment_seconds: float | None = None,
    sentinel: str = MISSING,
    complete: bool = True,
    exact_magnitudes: bool = True,
) -> DataFrame:
    """Raw readings -> magnitudes -> forward fill per user and activity -> complete rows.

    Rows without a user, activity or time are dropped, as in the bucket means. With
    ``complete`` rows that still miss a feature (ahead of its first reading, or staler
    than ``max_age`` seconds) are dropped, so the result feeds training as the
    bucket means do. The reduced readings are staged as Parquet in the shared folder.
    """
    reduced = with_magnitudes(drop_empty_rows(raw, KEY_COLUMNS, sentinel), sentinel=sentinel, exact=exact_magnitudes)
    keyed = reduced.where(F.col("user_id").isNotNull() & F.col("activity_id").isNotNull() & F.col("timestamp").isNotNull())
    # read three times below (widths, segment summaries, fill): the magnitudes are computed once
    staged = shared_dir(raw.sparkSession, "readings")
    write_outputs([keyed], [staged])
    keyed = read_parquet(raw.sparkSession, staged)
    filled = forward_fill(keyed, FEATURES, max_age=max_age, segment_seconds=segment_seconds).select(*OUTPUT_COLUMNS)
    return drop_incomplete(filled, FEATURES) if complete else filled
