"""What the stream queries land, and the settings their jobs run with."""

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

from kinesia.session import DEFAULT_CONF, JOB_KEYS, job_settings, shared_dir
from kinesia.streaming.late import BucketStream


def _events(spark, path, n, step=40):
    rows = spark.range(0, n, 1, 1).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * step).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 50).alias("user_id"),
        F.lit("click").alias("event_type"),
        (F.col("id") % 100).cast("double").alias("value"),
        F.lit('{"k": 3}').alias("props"),
    )
    rows.write.parquet(f"{path}/events.parquet")  # one file of one row group: one scan task
    return path


@pytest.mark.parametrize("n,files", [(600, 1), (70_000, 2)])
def test_large_slices_land_as_several_files(spark, n, files):
    source, landing = _events(spark, shared_dir(spark, "test-events"), n), shared_dir(spark, "test-slices")
    staged, per_slice = entry._staged_slices(spark, source)
    assert per_slice == files
    entry._land_out_of_order(spark, staged, per_slice, landing, range(3))
    early = spark.read.csv(landing)
    assert len(early.inputFiles()) == 3 * files
    assert 0 < early.count() < n
    entry._land_out_of_order(spark, staged, per_slice, landing, range(3, entry.LANDINGS))
    landed = spark.read.csv(landing)
    assert len(landed.inputFiles()) == entry.LANDINGS * files
    assert landed.count() == landed.distinct().count() == n


def test_a_stream_of_one_batch_is_past_its_first(spark):
    source, landing = _events(spark, shared_dir(spark, "test-events"), 50, 0), shared_dir(spark, "test-slices")
    staged, files = entry._staged_slices(spark, source)
    entry._land_out_of_order(spark, staged, files, landing, [0])
    tables = BucketStream(spark, shared_dir(spark, "test-tables"), entry.DAY_TICKS, entry.LATENESS_S)
    query = tables.route(entry.read_csv_stream(spark, landing), available_now=False)
    try:
        for _ in range(300):
            if entry._past_first_batch(query):
                break
            query.awaitTermination(0.2)
        assert query.isActive and entry._past_first_batch(query)
    finally:
        query.stop()


@pytest.fixture
def bare(spark):
    """The session without the library's settings, as a cluster may give it."""
    before = {k: spark.conf.get(k) for k in JOB_KEYS}
    for k in JOB_KEYS:
        spark.conf.unset(k)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_job_settings_hold_while_a_job_runs(bare):
    bare.conf.set(JOB_KEYS[0], "5000")
    with job_settings(bare):
        assert [bare.conf.get(k) for k in JOB_KEYS] == ["5000", *[DEFAULT_CONF[k] for k in JOB_KEYS[1:]]]
    assert bare.conf.get(JOB_KEYS[0]) == "5000"
    assert [bare.conf.get(k, None) for k in JOB_KEYS[1:]] == [None, None]


@pytest.mark.parametrize(
    "name,step",
    [
        ("stream_two_outputs_rows", "_two_outputs"),
        ("stream_two_outputs_means", "_two_outputs"),
        ("scaler_reload", "_job_artifacts"),
        ("train_job_results", "_job_artifacts"),
        ("model_reload_score", "_job_artifacts"),
        ("stream_score_reload", "_job_artifacts"),
        ("stream_score", "_train_on_events"),
        ("stream_preprocess", "_lateness"),
        ("stream_late_rows", "_staged_slices"),
        ("stream_restart", "_staged_slices"),
    ],
)
def test_queries_run_their_jobs_with_the_librarys_settings(bare, monkeypatch, name, step):
    seen = {}

    def stop(spark, sf_dir):
        seen.update({k: spark.conf.get(k) for k in JOB_KEYS})
        raise InterruptedError

    monkeypatch.setattr(entry, step, stop)
    with pytest.raises(InterruptedError):
        entry.queries()[name](bare, "/none")
    assert seen == {k: DEFAULT_CONF[k] for k in JOB_KEYS}
    assert [bare.conf.get(k, None) for k in JOB_KEYS] == [None] * len(JOB_KEYS)
