from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from imu_rows import raw_frame, raw_row
from kinesia.operators import (
    bucketed_mean,
    distinct_values,
    drop_empty_rows,
    drop_incomplete,
    drop_key,
    keep_key,
    measurement_columns,
    multi_agg,
    preview,
    row_count,
    sort_by,
    union_all,
    with_magnitudes,
)
from kinesia.plans.preprocess import preprocess
from kinesia.schema import AXIS_COLUMNS, KEY_COLUMNS, METRICS, OUTPUT_COLUMNS

ALL_NA = {c: "NA" for c in AXIS_COLUMNS}


def test_measurement_columns_by_exclusion(spark):
    df = raw_frame(spark, [raw_row(0.0, "walking", "a")])
    cols = measurement_columns(df, KEY_COLUMNS)
    assert cols[0] == "heart_rate" and len(cols) == 28


def test_drop_empty_rows_cases(spark):
    rows = [
        raw_row(1.00, "walking", "a", "NA", **ALL_NA),  # all 28 NA: dropped
        raw_row(1.01, "walking", "a", "100", **ALL_NA),  # IMU NA, HR present: kept
        raw_row(1.02, "walking", "a", "NA", **{**ALL_NA, "wrist_gyroscope_x": None}),  # NULL + NA: dropped (D1)
        raw_row(1.03, "walking", "a", "NA", **{**ALL_NA, "ankle_magnetometer_z": "0.5"}),  # one value: kept
        raw_row(1.04, "walking", "a", None, **{c: None for c in AXIS_COLUMNS}),  # all NULL: dropped
    ]
    kept = drop_empty_rows(raw_frame(spark, rows)).select("timestamp").collect()
    assert sorted(r.timestamp for r in kept) == [1.01, 1.03]


def test_with_magnitudes_shape_and_missing_axes(spark):
    rows = [
        raw_row(1.0, "walking", "a", "95", wrist_accelerometer_x="2.2153", wrist_accelerometer_y="8.27915",
                wrist_accelerometer_z="5.58753"),
        raw_row(1.01, "walking", "a", "NA", chest_gyroscope_y="NA"),  # only y missing
        raw_row(1.02, "walking", "a", "NA", chest_gyroscope_z="NA"),  # only z missing
    ]
    out = with_magnitudes(raw_frame(spark, rows))
    assert out.columns == ["timestamp", "activity_id", "heart_rate", *METRICS, "user_id"]
    got = out.orderBy("timestamp").collect()
    assert got[0].wrist_accelerometer == Decimal("10.2309515840")
    assert got[0].heart_rate == 95 and got[1].heart_rate is None
    assert got[1].chest_gyroscope is None and got[2].chest_gyroscope is None
    assert got[1].wrist_gyroscope == Decimal("1.7320508076")


def _reduced(spark, rows):
    return with_magnitudes(drop_empty_rows(raw_frame(spark, rows)))


def test_bucketed_mean_semantics(spark):
    rows = [
        # user a / walking, bucket 0 (ticks 0..10): two rows, one heart rate
        raw_row(0.00, "walking", "a", "100"),
        raw_row(0.05, "walking", "a", "NA", default="3.0"),
        # user b / walking shares bucket number 0: a separate row
        raw_row(0.02, "walking", "b", "80"),
        # user a / lying shares bucket number 0 too
        raw_row(0.03, "lying", "a", "60"),
        # user a / walking, bucket 1 without any heart rate: dropped
        raw_row(0.12, "walking", "a", "NA"),
        # bucket where one metric is missing in every row: dropped (any-NULL rule, D9)
        raw_row(0.25, "walking", "a", "90", ankle_gyroscope_x="NA"),
        # NULL user: dropped
        raw_row(0.01, "walking", None, "70"),
    ]
    out = bucketed_mean(_reduced(spark, rows), 11)
    assert out.columns == list(OUTPUT_COLUMNS)
    got = {(r.user_id, r.activity_id): r for r in out.collect()}
    assert set(got) == {("a", "walking"), ("b", "walking"), ("a", "lying")}
    aw = got[("a", "walking")]
    assert aw.timestamp == Decimal("0.03")  # mean of 0.00 and 0.05 over all rows, decimal(10,2)
    assert aw.heart_rate == 100.0
    assert aw.wrist_accelerometer == Decimal("3.46410161515000")  # mean of sqrt(3) and sqrt(27)
    assert str(out.schema["wrist_accelerometer"].dataType) == "DecimalType(19,14)"


def test_single_groupby_equals_per_key_loop(spark, events):
    """A5: one groupBy equals the reference's collect-keys / filter / aggregate / union loop."""
    from kinesia.sources.imu_view import imu_from_events

    reduced = with_magnitudes(drop_empty_rows(imu_from_events(events)))
    ours = bucketed_mean(reduced, 8_640_000)
    keys = [tuple(r) for r in reduced.select("user_id", "activity_id").distinct().collect()]
    parts = []
    for user, activity in keys[:12]:  # the loop is O(keys) jobs; a slice of keys keeps the test quick
        part = reduced.where((F.col("user_id") == user) & (F.col("activity_id") == activity))
        parts.append(bucketed_mean(part, 8_640_000))
    looped = union_all(*parts)
    subset = ours.join(looped.select("user_id", "activity_id").distinct(), ["user_id", "activity_id"])
    assert sorted(map(tuple, subset.select(*OUTPUT_COLUMNS).collect())) == sorted(map(tuple, looped.collect()))


def test_preprocess_end_to_end(spark):
    rows = [raw_row(t / 100, "walking", "a", "100" if t % 11 == 0 else "NA") for t in range(0, 44)]
    rows.append(raw_row(0.5, "walking", "a", "NA", **ALL_NA))
    out = preprocess(raw_frame(spark, rows))
    got = out.collect()
    assert [r.timestamp for r in got] == [Decimal("0.05"), Decimal("0.16"), Decimal("0.27"), Decimal("0.38")]
    assert all(r.heart_rate == 100.0 for r in got)


def test_multi_agg_variants(spark):
    df = spark.createDataFrame(
        [("a", "x", 1, 2.0), ("a", "x", 3, 4.0), ("b", "y", 5, 6.0)], "k string, c string, i int, d double"
    )
    avg = {r.k: r for r in multi_agg(df, ["k"], "avg", carry=["c"]).collect()}
    assert avg["a"].i == 2.0 and avg["a"].d == 3.0 and avg["a"].c == "x"
    assert {r.k: r.i for r in multi_agg(df, ["k"], "sum", carry=["c"]).collect()} == {"a": 4, "b": 5}
    assert {r.k: r.d for r in multi_agg(df, ["k"], "max", carry=["c"]).collect()} == {"a": 4.0, "b": 6.0}
    with pytest.raises(ValueError):
        multi_agg(df, ["k"], "median")


def test_filters_and_set_ops(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    assert [r.v for r in keep_key(df, "k", "a").collect()] == [1]
    assert [r.v for r in drop_key(df, "k", "a").collect()] == [2]  # NULL key is neither
    assert drop_incomplete(df).count() == 2
    assert row_count(df).first().n == 3
    assert distinct_values(union_all(df, df), "k").count() == 3
    swapped = df.select("v", "k")
    assert union_all(df, swapped).where("k = 'a'").count() == 2  # by name, not position
    top = preview(df, 2, order=[F.col("v").desc()]).collect()
    assert [r.v for r in top] == [3, 2]


def test_sort_by_orders_across_partitions(spark):
    df = spark.range(0, 1000, 1, 6).select(((F.col("id") * 7919) % 1000).alias("v"))
    assert [r.v for r in sort_by(df, F.col("v").desc()).collect()] == list(range(999, -1, -1))


def test_bucket_time_overflow_keeps_the_bucket(spark):
    rows = [raw_row(1.7e9, "walking", "a", "100"), raw_row(1.7e9 + 0.01, "walking", "a", "NA")]
    reduced = _reduced(spark, rows)
    narrow = bucketed_mean(reduced, 11).collect()
    assert len(narrow) == 1 and narrow[0].timestamp is None  # decimal(10,2) overflows: NULL, row kept
    from pyspark.sql import types as T

    wide = bucketed_mean(reduced, 11, time_type=T.DecimalType(16, 2)).collect()
    assert wide[0].timestamp == Decimal("1700000000.01")


def test_bucketed_mean_with_precomputed_ticks(spark):
    rows = [raw_row(t / 100, "walking", "a", "100" if t % 11 == 0 else "NA") for t in range(0, 22)]
    reduced = _reduced(spark, rows).withColumn("ts", F.round(F.col("timestamp") * 100).cast("int"))
    derived = bucketed_mean(reduced, 11).collect()
    given = bucketed_mean(reduced, 11, tick_col="ts").collect()
    assert sorted(derived) == sorted(given) and len(given) == 2
