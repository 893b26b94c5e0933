"""Job runners (J4): a job is a source, a ``DataFrame -> [DataFrame]`` step and sinks.

These replace the reference's pipeline class hierarchy with plain functions;
the three reference mains are ``preprocess_job``, ``train_job``, ``stream_job``.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kinesia.functions.time import bucket_width
from kinesia.ml.correlation import prune_features
from kinesia.ml.tree import Tree, train_tree
from kinesia.operators.signature import drop_outliers
from kinesia.plans.fill import fill_readings
from kinesia.plans.preprocess import preprocess
from kinesia.plans.stream import passthrough, score_stream, stream_preprocess
from kinesia.plans.train import TrainResult, train
from kinesia.schema import BUCKET_TIME_TYPE, FEATURES, HR_FREQ_HZ, IMU_FREQ_HZ, LABEL
from kinesia.sinks.console import console_stream_writer, show_outputs
from kinesia.sinks.files import write_outputs
from kinesia.sinks.kafka import kafka_stream_writer
from kinesia.sources.csv import read_csv, read_csv_stream
from kinesia.sources.models import load_pipeline
from kinesia.sources.parquet import read_features, read_parquet
from kinesia.streaming.late import BucketStream
from kinesia.streaming.runner import LateRows, await_all, await_any, claim_output, parquet_batches, start_outputs

log = logging.getLogger(__name__)


def run_batch(frames: Sequence[DataFrame], paths: Sequence[str] | None = None, *, console: bool = False) -> None:
    """Show the outputs (console) or write output *i* to path *i*."""
    if console:
        show_outputs(frames)
    else:
        write_outputs(frames, paths or [])


def run_stream(
    spark: SparkSession,
    frames: Sequence[DataFrame],
    checkpoint_root: str,
    *,
    sink: str = "console",
    output_mode: str = "append",
    timeout_ms: int = 0,
    available_now: bool = False,
    kafka: dict | None = None,
    paths: Sequence[str] | None = None,
) -> list[StreamingQuery]:
    """Start one query per output on the console, on Kafka or in Parquet files, then wait.

    Output *i* goes to path *i* of ``paths``: in append mode by Spark's file sink, else each
    micro-batch to its own folder, to be read with ``latest_rows``. Output and checkpoint
    belong together: a path that another checkpoint has written to raises ``ValueError``.
    Rows dropped by a watermark are reported as warnings while waiting, and raise
    ``RuntimeError`` at the end of an ``available_now`` run. If one query fails the others are
    stopped. After ``timeout_ms`` the queries go on, and a warning names them.
    """
    if sink == "files":
        if len(paths or []) != len(frames):
            raise ValueError(f"{len(frames)} outputs but {len(paths or [])} paths")
        for i, path in enumerate(paths):
            claim_output(spark, path, f"{checkpoint_root}/{i}")

        def writer(df, i):
            if output_mode == "append":
                return df.writeStream.format("parquet").outputMode("append").option("path", f"{paths[i]}/rows")
            return df.writeStream.outputMode(output_mode).foreachBatch(parquet_batches(f"{paths[i]}/rows"))
    elif sink == "console":
        def writer(df, i):
            return console_stream_writer(df, output_mode)
    elif sink == "kafka":
        opts = dict(kafka or {})
        if not opts.get("servers") or not opts.get("topic"):
            raise ValueError("the Kafka sink needs both 'servers' and 'topic'")

        def writer(df, i):
            return kafka_stream_writer(
                df, opts["servers"], opts["topic"], f"{checkpoint_root}/{i}", output_mode=output_mode,
                compression=opts.get("compression", "gzip"),
            )
    else:
        raise ValueError(f"unknown sink {sink!r}")
    queries = start_outputs(frames, writer, checkpoint_root, available_now=available_now)
    if available_now:
        await_all(queries, late=LateRows(queries))
    else:
        if not await_any(spark, queries, timeout_ms, LateRows(queries)):
            log.warning("still running after %d ms: %s", timeout_ms, ", ".join(str(q.name or q.id) for q in queries))
    return queries


def preprocess_job(
    spark: SparkSession, csv_path: str, out_path: str | None = None, *, console: bool = False, fill: bool = False, **options
) -> DataFrame:
    """Raw CSV -> bucket means, or with ``fill`` readings filled forward -> Parquet (or console)."""
    raw = read_csv(spark, csv_path)
    result = fill_readings(raw, **options) if fill else preprocess(raw, **options)
    run_batch([result], [out_path] if out_path else None, console=console)
    return result


def selected_features(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    *,
    target: str | None = "heart_rate",
    without_outliers: bool = False,
    pruned: bool = False,
    **limits,
) -> tuple[DataFrame, list[str]]:
    """(rows, features) to train on: rows unlike their label's signature go, then features that say nothing new.

    ``target`` itself is never pruned. ``limits`` are those of ``prune_features``.
    """
    rows = drop_outliers(df, features, [label]) if without_outliers else df
    if not pruned:
        return rows, list(features)
    gone = {p.feature for p in prune_features(rows, [f for f in features if f != target], target=target, label=label, **limits) if not p.kept}
    return rows, [f for f in features if f not in gone]


def train_job(
    spark: SparkSession,
    parquet_path: str,
    out_dir: str,
    *,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    without_outliers: bool = False,
    pruned: bool = False,
    **options,
) -> TrainResult:
    """Bucket means or filled readings -> model, scaler and hold-out predictions under ``out_dir``."""
    key = options.get("split_key") or []
    key = [c for c in ([key] if isinstance(key, str) else key) if c not in {*features, label}]
    data = read_features(spark, parquet_path, [*features, *key], label)
    data, features = selected_features(data, features, label, without_outliers=without_outliers, pruned=pruned)
    return train(data, features, label, out_dir=out_dir, **options)


def tree_job(
    spark: SparkSession,
    parquet_path: str,
    out_dir: str,
    *,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    split_key: Sequence[str] | str | None = None,
    without_outliers: bool = False,
    pruned: bool = False,
    **options,
) -> tuple[Tree, DataFrame]:
    """The training job with a decision tree: rules and hold-out predictions under ``out_dir``."""
    data, features = selected_features(read_parquet(spark, parquet_path), features, label, without_outliers=without_outliers, pruned=pruned)
    return train_tree(data, features, label, split_key=split_key or [*features, label], out_dir=out_dir, **options)


def stream_job(
    spark: SparkSession,
    input_dir: str,
    checkpoint_root: str,
    *,
    model_path: str | None = None,
    buckets: bool = False,
    max_files_per_trigger: int | None = None,
    watermark: str | None = None,
    with_bucket: bool | None = None,
    bucket_ticks: int | None = None,
    imu_freq_hz: float = IMU_FREQ_HZ,
    hr_freq_hz: float = HR_FREQ_HZ,
    time_type: T.DataType = BUCKET_TIME_TYPE,
    **run_options,
) -> list[StreamingQuery]:
    """Landing folder -> bucket means with ``buckets``, scored ones with a model, else the rows -> sink.

    The bucket width, given or by the rates, must be the one the model was trained on.
    Readings later than ``watermark`` behind the latest one are dropped, so it must be given
    for buckets: the delay of the landing files. ``run_stream`` reports such rows, and raises in
    ``available_now`` runs; ``bucket_tables_job`` keeps them. In update mode the bucket key is part of
    the output unless ``with_bucket`` is False: consumers need it to replace a bucket's earlier means.
    """
    stream = read_csv_stream(spark, input_dir, max_files_per_trigger=max_files_per_trigger)
    if model_path or buckets:
        if watermark is None:
            raise ValueError("buckets on a stream need a watermark: the delay of the landing files")
        mode = run_options.setdefault("output_mode", "append" if run_options.get("sink") == "files" else "update")
        options = {
            "bucket_ticks": bucket_ticks, "imu_freq_hz": imu_freq_hz, "hr_freq_hz": hr_freq_hz, "watermark": watermark,
            "with_bucket": mode == "update" if with_bucket is None else with_bucket, "time_type": time_type,
        }
        out = score_stream(stream, load_pipeline(model_path), **options) if model_path else stream_preprocess(stream, **options)
    else:
        out = passthrough(stream)
    return run_stream(spark, [out], checkpoint_root, **run_options)


def bucket_tables_job(
    spark: SparkSession,
    input_dir: str,
    out_path: str,
    *,
    lateness_seconds: float,
    max_files_per_trigger: int | None = None,
    bucket_ticks: int | None = None,
    imu_freq_hz: float = IMU_FREQ_HZ,
    hr_freq_hz: float = HR_FREQ_HZ,
    time_type: T.DataType = BUCKET_TIME_TYPE,
    timeout_s: float | None = None,
) -> BucketStream:
    """Process what has landed into the bucket tables under ``out_path``; run again when more has.

    Closed buckets are written once, late readings kept beside them; ``merged()`` of the
    result gives the means of all that has landed.
    """
    width = bucket_ticks if bucket_ticks is not None else bucket_width(imu_freq_hz, hr_freq_hz)
    tables = BucketStream(spark, out_path, width, lateness_seconds, time_type=time_type)
    tables.run(read_csv_stream(spark, input_dir, max_files_per_trigger=max_files_per_trigger), timeout_s)
    return tables


__all__ = [
    "bucket_tables_job",
    "preprocess_job",
    "run_batch",
    "run_stream",
    "selected_features",
    "stream_job",
    "train_job",
    "tree_job",
]
