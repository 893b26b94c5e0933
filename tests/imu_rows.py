"""Small raw IMU frames for tests, in the raw CSV's column order."""

from kinesia.schema import AXIS_COLUMNS, RAW_COLUMNS, raw_csv_schema


def raw_row(timestamp, activity, user, hr="NA", default="1.0", **axes):
    values = {c: default for c in AXIS_COLUMNS}
    values.update(axes)
    row = {"timestamp": timestamp, "activity_id": activity, "heart_rate": hr, "user_id": user, **values}
    return tuple(row[c] for c in RAW_COLUMNS)


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, raw_csv_schema())
