"""Streaming job (J3): CSV files landing in a folder -> (preprocess -> score) -> sink."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kinesia.functions.time import bucket_width
from kinesia.operators.filters import drop_empty_rows
from kinesia.operators.projections import with_magnitudes
from kinesia.plans.train import scoring_model
from kinesia.schema import BUCKET_TIME_TYPE, HR_FREQ_HZ, IMU_FREQ_HZ, KEY_COLUMNS, MISSING
from kinesia.streaming.windows import stream_bucketed_mean


def passthrough(df: DataFrame) -> DataFrame:
    """The reference's stream processor: rows out as they came in."""
    return df


def stream_preprocess(
    stream: DataFrame,
    *,
    bucket_ticks: int | None = None,
    imu_freq_hz: float = IMU_FREQ_HZ,
    hr_freq_hz: float = HR_FREQ_HZ,
    watermark: str,
    sentinel: str = MISSING,
    with_bucket: bool = False,
    time_type: T.DataType = BUCKET_TIME_TYPE,
) -> DataFrame:
    """The preprocessing job on a stream (T7): same filter and projection, then
    watermarked tumbling windows instead of a batch ``groupBy``."""
    width = bucket_ticks if bucket_ticks is not None else bucket_width(imu_freq_hz, hr_freq_hz)
    kept = drop_empty_rows(stream, KEY_COLUMNS, sentinel)
    reduced = with_magnitudes(kept, sentinel=sentinel)
    return stream_bucketed_mean(reduced, width, watermark=watermark, with_bucket=with_bucket, time_type=time_type)


def score_stream(
    stream: DataFrame,
    model: PipelineModel,
    *,
    watermark: str,
    **options,
) -> DataFrame:
    """Preprocess a raw stream and score each bucket with a saved pipeline.

    The pipeline is applied without its label indexer, so a bucket whose
    activity was never seen in training is still scored. Scoring is a
    row-wise map after the aggregate; the model's weights ship to executors
    once per query. ``options`` are those of ``stream_preprocess``.
    """
    buckets = stream_preprocess(stream, watermark=watermark, **options)
    return scoring_model(model).transform(buckets)
