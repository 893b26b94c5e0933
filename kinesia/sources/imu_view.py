"""An IMU-shaped raw table derived from the ``events`` table.

No sensor recording ships with the test data, so the preprocessing job runs
on a deterministic view of ``events`` with the raw CSV's 31 text columns.
The same rule renders as a Spark plan (``imu_from_events``) and as SQL text
(``imu_view_sql``) for the oracle; every events row becomes one IMU row, so
the view grows with the table.

Rule (one row per event):

* ``timestamp`` = seconds since 2024-01-01 00:00 (double),
  ``activity_id`` = ``event_type``, ``user_id`` = ``user_id`` as text;
* ``heart_rate`` = ``60 + event_id % 40`` as text on every 11th event id, else ``NA``
  (heart rate is sampled about 11 times less often than the IMU);
* metric number m (0..8, in ``METRICS`` order) has
  x = ``value * (-1)^m * (m+1)``, y = ``props.k * (m+2) / 4``,
  z = ``(user_id - 75) * (m+3) / 8``, each as ``decimal(12,5)`` text;
* all 27 axes are ``NA`` when ``event_id % 97 = 0`` (with no heart rate that row is
  empty and F1 drops it), the chest gyroscope's z is ``NA`` when
  ``event_id % 53 = 0`` and the ankle magnetometer's y is a real NULL when
  ``event_id % 71 = 0``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinesia.schema import AXES, METRICS, MISSING

EPOCH = "2024-01-01 00:00:00"
HR_EVERY = 11
ALL_NA_EVERY = 97
PARTIAL_NA = ("chest_gyroscope_z", 53)
NULL_CELL = ("ankle_magnetometer_y", 71)


def _axis_terms(m: int, axis: str) -> tuple[str, int, int]:
    """(source, multiplier, divisor) of one axis."""
    if axis == "x":
        return "value", (-1) ** m * (m + 1), 1
    if axis == "y":
        return "k", m + 2, 4
    return "centred_user", m + 3, 8


def event_seconds(ts: str = "ts") -> Column:
    """Seconds since ``EPOCH`` of a timestamp column, as double (microsecond exact)."""
    micros = F.expr(
        f"timestampdiff(MICROSECOND, CAST('{EPOCH}' AS TIMESTAMP_NTZ), CAST({ts} AS TIMESTAMP_NTZ))"
    )
    return micros.cast(T.DoubleType()) / F.lit(1_000_000.0)


def event_seconds_sql(ts: str = "ts") -> str:
    """``event_seconds`` as SQL text."""
    return f"(CAST(epoch_us({ts}) - epoch_us(TIMESTAMP '{EPOCH}') AS DOUBLE) / 1000000.0)"


def imu_from_events(events: DataFrame) -> DataFrame:
    """The raw-CSV-shaped view of ``events`` (Spark rendering of the rule)."""
    # Base values first, in their own projection: the JSON field feeds nine
    # axes and is parsed once per row instead of once per axis.
    base = events.select(
        "event_id",
        "event_type",
        "user_id",
        event_seconds().alias("_seconds"),
        F.col("value").alias("_value"),
        F.get_json_object("props", "$.k").try_cast(T.IntegerType()).cast(T.DoubleType()).alias("_k"),
        (F.col("user_id") - F.lit(75)).cast(T.DoubleType()).alias("_centred_user"),
    )
    eid = F.col("event_id")
    sources = {"value": F.col("_value"), "k": F.col("_k"), "centred_user": F.col("_centred_user")}
    cols: list[Column] = [
        F.col("_seconds").alias("timestamp"),
        F.col("event_type").alias("activity_id"),
        F.when(eid % HR_EVERY == 0, (F.lit(60) + eid % 40).cast("string"))
        .otherwise(F.lit(MISSING))
        .alias("heart_rate"),
    ]
    for m, metric in enumerate(METRICS):
        for axis in AXES:
            name = f"{metric}_{axis}"
            src, mult, div = _axis_terms(m, axis)
            text = (sources[src] * F.lit(float(mult)) / F.lit(float(div))).try_cast(
                T.DecimalType(12, 5)
            ).cast("string")
            missing = eid % ALL_NA_EVERY == 0
            if name == PARTIAL_NA[0]:
                missing = missing | (eid % PARTIAL_NA[1] == 0)
            value = F.when(missing, F.lit(MISSING)).otherwise(text)
            if name == NULL_CELL[0]:
                value = F.when(eid % NULL_CELL[1] == 0, F.lit(None).cast("string")).otherwise(value)
            cols.append(value.alias(name))
    cols.append(F.col("user_id").cast("string").alias("user_id"))
    return base.select(*cols)


def imu_view_sql(events: str = "events") -> str:
    """The same rule as ANSI/DuckDB SQL text (for the oracle)."""
    src_sql = {
        "value": "value",
        "k": "CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE)",
        "centred_user": "CAST(user_id - 75 AS DOUBLE)",
    }
    parts = [
        f"{event_seconds_sql()} AS timestamp",
        "event_type AS activity_id",
        f"CASE WHEN event_id % {HR_EVERY} = 0 THEN CAST(60 + event_id % 40 AS VARCHAR) "
        f"ELSE '{MISSING}' END AS heart_rate",
    ]
    for m, metric in enumerate(METRICS):
        for axis in AXES:
            name = f"{metric}_{axis}"
            src, mult, div = _axis_terms(m, axis)
            text = (
                f"CAST(CAST({src_sql[src]} * CAST({mult} AS DOUBLE) / CAST({div} AS DOUBLE) "
                f"AS DECIMAL(12,5)) AS VARCHAR)"
            )
            missing = f"event_id % {ALL_NA_EVERY} = 0"
            if name == PARTIAL_NA[0]:
                missing = f"({missing} OR event_id % {PARTIAL_NA[1]} = 0)"
            expr = f"CASE WHEN {missing} THEN '{MISSING}' ELSE {text} END"
            if name == NULL_CELL[0]:
                expr = f"CASE WHEN event_id % {NULL_CELL[1]} = 0 THEN NULL ELSE {expr} END"
            parts.append(f"{expr} AS {name}")
    parts.append("CAST(user_id AS VARCHAR) AS user_id")
    return "SELECT " + ",\n  ".join(parts) + f"\nFROM {events}"
