from pyspark.sql import functions as F

from kinesia.plans.preprocess import preprocess
from kinesia.plans.stream import passthrough, score_stream, stream_preprocess
from kinesia.plans.train import train
from kinesia.schema import FEATURES, OUTPUT_COLUMNS
from kinesia.session import shared_dir
from kinesia.sinks.files import write_csv
from kinesia.sources.csv import read_csv_stream
from kinesia.sources.imu_view import imu_from_events
from kinesia.streaming.runner import await_all, latest_rows, parquet_batches, start_outputs

DAY = 8_640_000


def _landing(spark, events, files=3):
    path = shared_dir(spark, "test-landing")
    write_csv(imu_from_events(events).repartition(files), path, header=False)
    return path


def _run_update(spark, frame, keys):
    out, ckpt = shared_dir(spark, "test-out"), shared_dir(spark, "test-ckpt")

    def writer(df, i):
        return df.writeStream.outputMode("update").foreachBatch(parquet_batches(out))

    await_all(start_outputs([frame], writer, ckpt, available_now=True))
    return latest_rows(spark, out, keys)


def test_stream_identity_reads_every_row(spark, events):
    landing = _landing(spark, events)
    out, ckpt = shared_dir(spark, "test-id-out"), shared_dir(spark, "test-id-ckpt")
    stream = passthrough(read_csv_stream(spark, landing, max_files_per_trigger=1))

    def writer(df, i):
        return df.writeStream.format("parquet").outputMode("append").option("path", out)

    queries = start_outputs([stream], writer, ckpt, available_now=True)
    await_all(queries)
    assert queries[0].lastProgress is not None
    got = spark.read.parquet(out)
    assert got.count() == events.count()
    assert dict(got.dtypes)["wrist_accelerometer_x"] == "decimal(15,10)"
    assert got.where(F.col("heart_rate").isNotNull()).count() == events.where("event_id % 11 = 0").count()


def test_stream_preprocess_equals_batch(spark, events):
    landing = _landing(spark, events)
    stream = read_csv_stream(spark, landing, max_files_per_trigger=1)
    frame = stream_preprocess(stream, bucket_ticks=DAY, watermark="31 days", with_bucket=True)
    streamed = _run_update(spark, frame, ["user_id", "activity_id", "bucket"]).drop("bucket")
    batch = preprocess(imu_from_events(events), bucket_ticks=DAY, ordered=False)
    a = streamed.select(*OUTPUT_COLUMNS)
    assert a.count() == batch.count() > 0
    assert a.exceptAll(batch).count() == 0 and batch.exceptAll(a).count() == 0


def test_append_mode_emits_closed_buckets_only(spark, events):
    landing = shared_dir(spark, "test-ordered")
    write_csv(imu_from_events(events.repartitionByRange(4, "ts")), landing, header=False)
    out, ckpt = shared_dir(spark, "test-app-out"), shared_dir(spark, "test-app-ckpt")
    stream = read_csv_stream(spark, landing, max_files_per_trigger=1)
    frame = stream_preprocess(stream, bucket_ticks=DAY, watermark="1 hour")

    def writer(df, i):
        return df.writeStream.format("parquet").outputMode("append").option("path", out)

    await_all(start_outputs([frame], writer, ckpt, available_now=True))
    emitted = spark.read.parquet(out)
    batch = preprocess(imu_from_events(events), bucket_ticks=DAY, ordered=False)
    # files in time order: no row is late, every emitted (closed) bucket equals its batch twin
    assert 0 < emitted.count() <= batch.count()
    assert emitted.exceptAll(batch).count() == 0


def test_stream_scores_equal_batch_scores(spark, events):
    buckets = preprocess(imu_from_events(events), bucket_ticks=DAY, ordered=False)
    result = train(buckets, seed=2, max_iter=20)
    landing = _landing(spark, events)
    stream = read_csv_stream(spark, landing, max_files_per_trigger=1)
    scored = score_stream(stream, result.model, bucket_ticks=DAY, watermark="31 days", with_bucket=True)
    frame = scored.select(*OUTPUT_COLUMNS, "bucket", "predictedLabel")
    streamed = _run_update(spark, frame, ["user_id", "activity_id", "bucket"]).drop("bucket")
    batch_scores = result.scorer.transform(buckets).select(*OUTPUT_COLUMNS, "predictedLabel")
    assert streamed.count() == batch_scores.count()
    assert streamed.exceptAll(batch_scores).count() == 0
    assert set(FEATURES) <= set(streamed.columns)


def test_await_any_times_out_while_queries_run(spark):
    from kinesia.sinks.console import console_stream_writer
    from kinesia.streaming.runner import await_any

    empty = shared_dir(spark, "test-empty-landing")
    spark.range(0).write.mode("overwrite").csv(empty)  # folder exists, no rows
    stream = read_csv_stream(spark, empty)
    queries = start_outputs(
        [stream], lambda df, i: console_stream_writer(df).trigger(processingTime="1 second"),
        shared_dir(spark, "test-await-ckpt"),
    )
    try:
        assert await_any(spark, queries, timeout_ms=1500) is False
        assert queries[0].isActive
    finally:
        for q in queries:
            q.stop()
    assert not queries[0].isActive
