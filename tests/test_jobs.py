"""The three reference mains as job functions, end to end."""

import pytest
from pyspark.sql import types as T

from kinesia.plans.jobs import preprocess_job, run_batch, stream_job, train_job
from kinesia.schema import FEATURES, LABEL, OUTPUT_COLUMNS
from kinesia.session import apply_defaults, shared_dir
from kinesia.sinks.files import write_csv
from kinesia.sources.imu_view import imu_from_events
from kinesia.streaming.runner import latest_rows

DAY = 8_640_000


def test_preprocess_train_stream_jobs(spark, events):
    raw_dir = shared_dir(spark, "job-raw")
    write_csv(imu_from_events(events), raw_dir, header=True)
    buckets_dir, model_dir = shared_dir(spark, "job-buckets"), shared_dir(spark, "job-model")

    result = preprocess_job(spark, raw_dir, buckets_dir, bucket_ticks=DAY)
    written = spark.read.parquet(buckets_dir)
    assert written.columns == list(OUTPUT_COLUMNS) and written.count() == result.count() > 0

    trained = train_job(spark, buckets_dir, model_dir, seed=5, max_iter=15)
    assert 0.0 <= trained.accuracy() <= 1.0
    assert spark.read.parquet(f"{model_dir}/test_results").count() == trained.test.count()
    assert set(FEATURES) | {LABEL} <= set(trained.train.columns)

    landing = shared_dir(spark, "job-landing")
    write_csv(imu_from_events(events).repartition(2), landing, header=False)
    target, ckpt = shared_dir(spark, "job-scores"), shared_dir(spark, "job-ckpt")
    options = {"model_path": f"{model_dir}/model", "bucket_ticks": DAY, "watermark": "31 days", "available_now": True}
    queries = stream_job(spark, landing, ckpt, sink="files", paths=[target], output_mode="update", **options)
    assert all(not q.isActive for q in queries)
    assert sum(p["numInputRows"] for p in queries[0].recentProgress) == events.count()
    scores = latest_rows(spark, f"{target}/rows", ["user_id", "activity_id", "bucket"]).select(*OUTPUT_COLUMNS, "predictedLabel")
    batch = trained.scorer.transform(written).select(*OUTPUT_COLUMNS, "predictedLabel")
    assert scores.count() == batch.count() and scores.exceptAll(batch).count() == 0
    stream_job(spark, landing, ckpt, sink="files", paths=[target], output_mode="update", **options)  # nothing new, same owner
    with pytest.raises(ValueError, match="belongs to the checkpoint"):
        stream_job(spark, landing, shared_dir(spark, "job-other"), sink="files", paths=[target], output_mode="update", **options)
    with pytest.raises(ValueError, match="watermark"):
        stream_job(spark, landing, shared_dir(spark, "job-none"), buckets=True)
    closed = shared_dir(spark, "job-closed")
    stream_job(
        spark, landing, shared_dir(spark, "job-rates"), buckets=True, watermark="31 days", imu_freq_hz=8_640_000, hr_freq_hz=1,
        time_type=T.DecimalType(20, 4), sink="files", paths=[closed], available_now=True,
    )
    stored = spark.read.schema(f"timestamp decimal(20,4), {LABEL} string").parquet(f"{closed}/rows")
    assert stored.count() == 0  # append mode: nothing has closed within 31 days


def test_run_batch_writes_or_shows(spark):
    path = shared_dir(spark, "job-batch")
    run_batch([spark.range(3)], [path])
    assert spark.read.parquet(path).count() == 3
    run_batch([spark.range(3)], console=True)  # prints from the JVM


def test_command_line_runs_the_three_jobs(spark, events):
    from kinesia.cli import main

    raw = shared_dir(spark, "cli-raw")
    write_csv(imu_from_events(events), raw, header=True)
    buckets, model = shared_dir(spark, "cli-buckets"), shared_dir(spark, "cli-model")
    main(["preprocess", "--input", raw, "--output", buckets, "--bucket-ticks", str(DAY), "--no-sort", "--fast-magnitudes"], spark)
    assert spark.read.parquet(buckets).count() > 0
    summary = main(["train", "--input", buckets, "--output", model, "--max-iter", "10"], spark)
    assert len(summary["labels"]) == 5 and 0.0 <= summary["accuracy"] <= 1.0
    landing = shared_dir(spark, "cli-landing")
    write_csv(imu_from_events(events), landing, header=False)
    out = main(["stream", "--input", landing, "--checkpoint", shared_dir(spark, "cli-ckpt"),
                "--model", f"{model}/model", "--available-now", "--watermark", "31 days"], spark)
    assert len(out["queries"]) == 1
    tables, merged = shared_dir(spark, "cli-tables"), shared_dir(spark, "cli-merged")
    out = main(["tables", "--input", landing, "--output", tables, "--lateness", "86400", "--bucket-ticks", str(DAY), "--merged", merged], spark)
    assert out["late"] == 0 and spark.read.parquet(merged).count() == spark.read.parquet(buckets).count()
    tree = main(["train", "--input", buckets, "--output", shared_dir(spark, "cli-tree"), "--tree", "--max-depth", "2"], spark)
    assert 1 <= len(tree["rules"]) <= 4 and 0.0 <= tree["accuracy"] <= 1.0
    filled = shared_dir(spark, "cli-filled")
    main(["preprocess", "--input", raw, "--output", filled, "--fill", "--fast-magnitudes"], spark)
    assert spark.read.parquet(filled).count() > spark.read.parquet(buckets).count()


def test_kafka_sink_requires_servers_and_topic(spark):
    import pytest

    from kinesia.plans.jobs import run_stream

    with pytest.raises(ValueError, match="topic"):
        run_stream(spark, [], shared_dir(spark, "kafka-ckpt"), sink="kafka", kafka={"servers": "h:9092"})


def test_session_defaults_do_not_replace_what_is_set(spark):
    key, kept = "spark.sql.codegen.hugeMethodLimit", "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.unset(key)
    spark.conf.set(kept, "false")
    try:
        apply_defaults(spark)
        assert spark.conf.get(key) == "8000"
        assert spark.conf.get(kept) == "false"
    finally:
        spark.conf.set(key, before)
        spark.conf.set(kept, "true")
