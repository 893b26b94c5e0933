import logging

import pytest

from kinesia.plans.jobs import run_stream
from kinesia.plans.stream import stream_preprocess
from kinesia.session import shared_dir
from kinesia.sinks.files import write_csv
from kinesia.sources.csv import read_csv_stream
from kinesia.sources.imu_view import imu_from_events


def test_rows_dropped_by_the_watermark_are_not_silent(spark, events, caplog):
    landing = shared_dir(spark, "late-in")
    write_csv(imu_from_events(events).repartition(4), landing, header=False)
    stream = read_csv_stream(spark, landing, max_files_per_trigger=1)

    def run(watermark):
        frame = stream_preprocess(stream, bucket_ticks=8_640_000, watermark=watermark)
        run_stream(spark, [frame], shared_dir(spark, "late-ckpt"), output_mode="update", available_now=True)

    with caplog.at_level(logging.WARNING), pytest.raises(RuntimeError, match="watermark dropped"):
        run("10 minutes")
    assert "the watermark dropped" in caplog.text
    run("365 days")
