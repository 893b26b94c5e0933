"""Data model of the wearable-sensor suite: column names, schemas, fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the reference's data model) -------------------
# Body parts, sensors and axes in the raw column order, the missing-value
# sentinel, the carried key columns, the sampling rates and the class labels
# the reference's saved model lists, in index order.
BODY_PARTS = ("wrist", "chest", "ankle")
SENSORS = ("accelerometer", "gyroscope", "magnetometer")
AXES = ("x", "y", "z")
MISSING = "NA"
KEY_COLUMNS = ("timestamp", "activity_id", "user_id")
IMU_FREQ_HZ = 100
HR_FREQ_HZ = 9
TICKS_PER_SECOND = 100
ACTIVITY_LABELS = (
    "walking", "lying", "standing", "sitting", "cycling",
    "ascending_stairs", "descending_stairs", "running", "rope_jumping",
)
# ---------------------------------------------------------------------------

METRICS = tuple(f"{b}_{s}" for b in BODY_PARTS for s in SENSORS)
AXIS_COLUMNS = tuple(f"{m}_{a}" for m in METRICS for a in AXES)
MEASUREMENT_COLUMNS = ("heart_rate",) + AXIS_COLUMNS
FEATURES = ("heart_rate",) + METRICS
LABEL = "activity_id"
OUTPUT_COLUMNS = ("timestamp", "user_id", "activity_id") + FEATURES
RAW_COLUMNS = ("timestamp", "activity_id", "heart_rate") + AXIS_COLUMNS + ("user_id",)

MAGNITUDE_TYPE = T.DecimalType(15, 10)
BUCKET_TIME_TYPE = T.DecimalType(10, 2)


def _schema(heart_rate: T.DataType, axis: T.DataType) -> T.StructType:
    fields = [
        T.StructField("timestamp", T.DoubleType(), False),
        T.StructField("activity_id", T.StringType(), False),
        T.StructField("heart_rate", heart_rate, True),
    ]
    fields += [T.StructField(c, axis, True) for c in AXIS_COLUMNS]
    fields.append(T.StructField("user_id", T.StringType(), True))
    return T.StructType(fields)


def raw_csv_schema() -> T.StructType:
    """Batch CSV: every measurement is text so the ``NA`` sentinel survives the read."""
    return _schema(T.StringType(), T.StringType())


def stream_csv_schema() -> T.StructType:
    """Streaming CSV: measurements typed; a sentinel cell parses to NULL."""
    return _schema(T.DecimalType(10, 2), T.DecimalType(15, 10))
