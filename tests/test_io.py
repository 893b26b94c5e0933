import json

import pytest
from pyspark.sql import functions as F

from imu_rows import raw_frame, raw_row
from kinesia.schema import RAW_COLUMNS, stream_csv_schema
from kinesia.session import shared_dir
from kinesia.sinks.files import write_csv, write_outputs, write_single_file
from kinesia.sinks.kafka import kafka_payload
from kinesia.sources.csv import read_csv
from kinesia.sources.parquet import read_features, read_parquet


def test_csv_reader_keeps_sentinels_as_text(spark):
    path = shared_dir(spark, "test-csv")
    rows = [raw_row(37.66, "lying", "a", "100", wrist_accelerometer_x="2.2153"), raw_row(37.67, "lying", "a")]
    write_csv(raw_frame(spark, rows), path, header=True)
    back = read_csv(spark, path)
    assert back.columns == list(RAW_COLUMNS)
    got = back.orderBy("timestamp").collect()
    assert got[0].heart_rate == "100" and got[1].heart_rate == "NA" and got[0].wrist_accelerometer_x == "2.2153"


def test_stream_schema_parses_sentinel_to_null(spark, tmp_path):
    line = ",".join(["37.66", '"lying"', "NA"] + ["1.5"] * 26 + ["NA", '"a"'])
    (tmp_path / "batch.csv").write_text(line + "\n")
    df = spark.read.schema(stream_csv_schema()).option("header", False).csv(str(tmp_path))
    row = df.first()
    assert row.heart_rate is None and row.ankle_magnetometer_z is None
    assert str(row.wrist_accelerometer_x) == "1.5000000000" and row.user_id == "a"


def test_write_outputs_pairs_frames_with_paths(spark):
    df = spark.range(5)
    a, b = shared_dir(spark, "test-out-a"), shared_dir(spark, "test-out-b")
    write_outputs([df, df.where("id > 2")], [a, b])
    assert read_parquet(spark, a).count() == 5 and read_parquet(spark, b).count() == 2
    with pytest.raises(ValueError):
        write_outputs([df], [a, b])


def test_single_file_and_feature_projection(spark):
    path = shared_dir(spark, "test-single")
    df = spark.range(100).select(F.col("id").cast("double").alias("f1"), (F.col("id") * 2.0).alias("f2"),
                                 F.lit("walk").alias("label"), F.lit(1).alias("extra")).repartition(4)
    write_single_file(df, path)
    files = [f for f in spark.sparkContext.wholeTextFiles(path).keys().collect() if f.endswith(".parquet")]
    assert len(files) == 1
    assert read_features(spark, path, ["f1", "f2"], "label").columns == ["f1", "f2", "label"]


def test_kafka_payload_is_json_of_the_row(spark, events):
    payload = kafka_payload(events.select("event_id", "user_id", "event_type", "value"), "user_id")
    assert payload.columns == ["key", "value"]
    row = payload.orderBy(F.col("key").cast("long"), F.get_json_object("value", "$.event_id").cast("long")).first()
    parsed = json.loads(row.value)
    assert set(parsed) == {"event_id", "user_id", "event_type", "value"} and row.key == str(parsed["user_id"])
    assert kafka_payload(events, None).columns == ["value"]
