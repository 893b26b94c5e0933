"""Bucket tables of a stream: late readings kept, state bounded, restarts and repeats counted once."""

import pytest
from pyspark.sql import functions as F

from imu_rows import raw_frame, raw_row
from kinesia.plans.jobs import bucket_tables_job, run_stream
from kinesia.plans.preprocess import preprocess
from kinesia.session import shared_dir
from kinesia.sources.csv import read_csv_stream
from kinesia.streaming.late import BucketStream
from kinesia.streaming.runner import await_all, start_outputs

WIDTH = 1000  # ticks: buckets of 10 s


def _rows(start, stop, user="u", step=1.0):
    n = int((stop - start) / step)
    return [raw_row(start + i * step, "walk", user, hr=str(60 + i % 7), default=str(1.5 + i % 5)) for i in range(n)]


def _land(spark, folder, rows):
    raw_frame(spark, rows).coalesce(1).write.mode("append").csv(folder, header=False)


def _same(a, b):
    assert a.count() == b.count() > 0
    digits = lambda df: sorted(tuple(None if v is None else (round(float(v), 6) if not isinstance(v, str) else v) for v in r) for r in df.collect())
    assert digits(a) == digits(b)


LATE = _rows(3.0, 6.0) + _rows(12.5, 14.0, "v")
PARTS = [
    _rows(0, 100) + _rows(0, 40, "v"),
    _rows(100, 200),
    LATE + _rows(200, 300) + [raw_row(None, "walk", "u"), raw_row(250.0, "walk", None)],
    _rows(300, 330) + _rows(60, 70, "w"),
]


def test_late_rows_are_kept_and_merged_and_state_is_evicted(spark):
    landing, out = shared_dir(spark, "bt-in"), shared_dir(spark, "bt-out")
    everything = []
    for rows in PARTS:
        rows = [r for r in rows if r[0] is not None]
        everything += rows
        _land(spark, landing, rows)
        tables = bucket_tables_job(spark, landing, out, lateness_seconds=20, bucket_ticks=WIDTH)
        _same(tables.merged(), preprocess(raw_frame(spark, everything), bucket_ticks=WIDTH, ordered=False))
    assert tables.late().count() == len(LATE) + 10
    closed = tables.closed()
    assert closed.count() == closed.select("user_id", "activity_id", "_bucket_end").distinct().count()  # each once
    assert closed.agg(F.max("_bucket_end")).first()[0] <= (330 - 20) * 1000
    last = [q for q in tables.run(read_csv_stream(spark, landing)) if q.lastProgress][-1:]
    for q in last:
        for op in q.lastProgress["stateOperators"]:
            assert op["numRowsTotal"] <= 4 and op["numRowsDroppedByWatermark"] == 0


def test_everything_open_and_empty_folder(spark):
    landing, out = shared_dir(spark, "bt-open-in"), shared_dir(spark, "bt-open-out")
    rows = _rows(0, 50)
    _land(spark, landing, rows)
    tables = bucket_tables_job(spark, landing, out, lateness_seconds=10**6, bucket_ticks=WIDTH)
    assert tables.closed().count() == 0 and tables.late().count() == 0
    _same(tables.merged(), preprocess(raw_frame(spark, rows), bucket_ticks=WIDTH, ordered=False))


def test_a_repeated_batch_counts_once(spark):
    """A batch written before the driver died is written again under its own number."""
    out = shared_dir(spark, "bt-repeat")
    tables = BucketStream(spark, out, WIDTH, 20.0)
    from kinesia.streaming.late import reduced_readings

    batches = [reduced_readings(raw_frame(spark, [r for r in p if r[0] is not None])) for p in PARTS]
    for i, b in enumerate(batches):
        tables._routed(b, i)
        tables._routed(b, i)
    assert spark.read.parquet(f"{out}/readings").count() == sum(b.count() for b in batches)
    assert tables._mark(len(PARTS) - 1) == 329_000
    await_all([tables.close()])
    whole = raw_frame(spark, [r for p in PARTS for r in p if r[0] is not None])
    _same(tables.merged(), preprocess(whole, bucket_ticks=WIDTH, ordered=False))


def test_stop_between_batches_and_resume(spark):
    landing, out = shared_dir(spark, "bt-stop-in"), shared_dir(spark, "bt-stop-out")
    for p in PARTS:
        _land(spark, landing, [r for r in p if r[0] is not None])
    tables = BucketStream(spark, out, WIDTH, 20.0)
    query = tables.route(read_csv_stream(spark, landing, max_files_per_trigger=1), available_now=False)
    while query.isActive and (query.lastProgress is None or query.lastProgress["batchId"] < 1):
        query.awaitTermination(0.1)
    query.stop()
    ran = tables.run(read_csv_stream(spark, landing, max_files_per_trigger=1))
    assert ran[0].id == query.id and ran[0].runId != query.runId  # the same query, another run
    whole = raw_frame(spark, [r for p in PARTS for r in p if r[0] is not None])
    _same(tables.merged(), preprocess(whole, bucket_ticks=WIDTH, ordered=False))


def test_failure_of_one_output_stops_the_other(spark):
    landing = shared_dir(spark, "bt-fail-in")
    _land(spark, landing, _rows(0, 20))
    stream = read_csv_stream(spark, landing)

    def writer(df, i):
        def fail(batch, batch_id):
            raise ValueError("this output is broken")

        if i == 0:
            return df.writeStream.format("noop")
        return df.writeStream.foreachBatch(fail)

    queries = start_outputs([stream, stream], writer, shared_dir(spark, "bt-fail-ckpt"))
    with pytest.raises(RuntimeError, match="failed"):
        await_all(queries, timeout_s=120)
    assert not any(q.isActive for q in queries)


def test_file_sink_wants_a_path_per_output(spark):
    with pytest.raises(ValueError, match="1 outputs but 0 paths"):
        run_stream(spark, [spark.range(1)], shared_dir(spark, "bt-ckpt"), sink="files")
