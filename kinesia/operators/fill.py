"""Forward fill of missing readings per series.

A series is a (user, activity) pair. Every missing value takes the last reading of its
column in the same series. A plain window over the series would bring a whole series
into one task, so time is cut into segments:

1. a summary keeps the last reading of every column per series and segment (written to
   the shared folder);
2. a prefix over the summaries gives what each segment starts with. Both the last
   reading and the prefix are a maximum over (time, value) pairs, so segments merge into
   groups of ``FAN`` and the prefix runs over the groups first: no window holds more
   than ``FAN`` summaries of a series, up to ``FAN`` ** 2 segments;
3. rows are dealt by (series, segment), joined with what their segment starts with, and
   filled by a window inside the segment. This is the only shuffle of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinesia.session import shared_dir

FAN = 4096
SEGMENT_ROWS = 1_000_000
_SEGMENT, _GROUP = "_fill_segment", "_fill_group"


def _seen(column: str) -> str:
    return f"_seen_{column}"


def _reading(column: str, time: str) -> Column:
    """(time, value) of a present value, else NULL; the largest is the last reading."""
    return F.when(F.col(column).isNotNull(), F.struct(F.col(time).alias("at"), F.col(column).alias("value")))


def segment_width(df: DataFrame, keys: Sequence[str], time: str, rows: int = SEGMENT_ROWS) -> float | None:
    """Seconds that hold about ``rows`` rows of the densest series; None if no series has more rows.

    One aggregate with a row per series; a single number reaches the driver.
    """
    series = df.where(F.col(time).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), (F.max(time) - F.min(time)).alias("span"))
    dense = series.where((F.col("n") > rows) & (F.col("span") > 0))
    return dense.agg(F.min(F.col("span") * F.lit(float(rows)) / F.col("n"))).first()[0]


def segment_starts(rows: DataFrame, columns: Sequence[str], keys: Sequence[str], time: str, fan: int = FAN) -> DataFrame:
    """(keys, segment, last reading per column before the segment) of rows that carry their segment."""
    seen = [_seen(c) for c in columns]
    group = F.floor(F.col(_SEGMENT) / F.lit(fan)).alias(_GROUP)
    last = rows.groupBy(*keys, _SEGMENT, group).agg(*[F.max(_reading(c, time)).alias(s) for c, s in zip(columns, seen)])
    path = shared_dir(rows.sparkSession, "segment-summaries")  # read twice below
    last.write.parquet(path)
    last = rows.sparkSession.read.schema(last.schema).parquet(path)
    groups = last.groupBy(*keys, _GROUP).agg(*[F.max(s).alias(s) for s in seen])
    before = Window.partitionBy(*keys).orderBy(_GROUP).rowsBetween(Window.unboundedPreceding, -1)
    heads = groups.select(*keys, _GROUP, *[F.max(s).over(before).alias(f"{s}_head") for s in seen])
    inside = Window.partitionBy(*keys, _GROUP).orderBy(_SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    starts = last.select(*keys, _SEGMENT, _GROUP, *[F.max(s).over(inside).alias(s) for s in seen])
    joined = starts.join(heads, [*keys, _GROUP])
    return joined.select(*keys, _SEGMENT, *[F.greatest(s, f"{s}_head").alias(f"{s}_start") for s in seen])


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str] = ("user_id", "activity_id"),
    time: str = "timestamp",
    max_age: float | None = None,
    segment_seconds: float | None = None,
    fan: int = FAN,
) -> DataFrame:
    """``df`` with NULLs of ``columns`` replaced by the series' last reading of that column.

    Values ahead of a series' first reading stay NULL, and so do values whose last
    reading is more than ``max_age`` seconds old, if that is given. Readings of one
    instant count as one: a missing value takes the largest of them. Rows with a NULL key
    or time belong to no series: they come back as they are and fill nothing. Repeated
    rows come back as often. ``segment_seconds`` is the width of a time segment; by
    default it is chosen so that a segment of the densest series has about
    ``SEGMENT_ROWS`` rows, and series that are all shorter are not cut. Rows of one series
    at one instant cannot be split. Columns keep their order and types.
    """
    columns, keys = list(columns), list(keys)
    width = segment_seconds if segment_seconds is not None else segment_width(df, keys, time)
    placed = F.col(time).isNotNull()
    for k in keys:
        placed = placed & F.col(k).isNotNull()
    segment = F.floor(F.col(time) / F.lit(float(width))).cast("long") if width else F.lit(0).cast("long")
    # rows of no series are spread by their content, so that they never meet in one task
    rows = df.withColumn(_SEGMENT, F.when(placed, segment).otherwise(F.xxhash64(*df.columns)))
    order = Window.partitionBy(*keys, _SEGMENT).orderBy(time).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    if width:
        starts = segment_starts(rows.where(placed), columns, keys, time, fan)
        rows = rows.join(starts, [*keys, _SEGMENT], "left")
    seen = rows.select("*", *[F.max(_reading(c, time)).over(order).alias(_seen(c)) for c in columns])
    filled = {}
    for c in columns:
        last = F.greatest(_seen(c), f"{_seen(c)}_start") if width else F.col(_seen(c))
        usable = placed if max_age is None else placed & (F.col(time) - last["at"] <= F.lit(float(max_age)))
        filled[c] = F.coalesce(F.col(c), F.when(usable, last["value"])).alias(c)
    return seen.select(*[filled.get(c, F.col(c)) for c in df.columns])
