"""


Every query reads the given tables whole (or a view Spark derives from them
row for row, see ``kinesia.sources.imu_view``). Computed columns carry the same
alias on both sides; doubles out of aggregates are rounded to the same number
of digits on both sides and decimals are returned as doubles. Queries that
exercise a source or sink stage their input under the shared folder named by
``spark.checkpoint.dir`` and read it back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinesia.functions import bucket_index, bucket_width, composite_key, joined_values, magnitude, time_tick
from kinesia.functions.missing import sentinel_to_null, to_int
from kinesia.ml.correlation import correlations, prune_features
from kinesia.ml.evaluate import accuracy_frame
from kinesia.ml.features import assembler, category_indexer, fit_labels, standardize
from kinesia.ml.split import HASH_MODULUS, HASH_MULTIPLIER, split_position
from kinesia.ml.tree import CELLS, LEAST_GAIN, SCALE, fit_tree
from kinesia.operators import (
    distinct_values,
    drop_empty_rows,
    drop_incomplete,
    drop_key,
    keep_key,
    multi_agg,
    preview,
    row_count,
    sort_by,
    union_all,
    with_magnitudes,
)
from kinesia.operators.signature import GRID, flag_outliers, group_likeness
from kinesia.plans.fill import fill_readings
from kinesia.plans.jobs import preprocess_job, run_stream, stream_job, train_job
from kinesia.plans.preprocess import preprocess
from kinesia.plans.stream import passthrough, score_stream, stream_preprocess
from kinesia.plans.train import hold_out_results, scoring_model, train
from kinesia.schema import (
    AXES,
    FEATURES,
    HR_FREQ_HZ,
    IMU_FREQ_HZ,
    LABEL,
    MEASUREMENT_COLUMNS,
    METRICS,
    MISSING,
    OUTPUT_COLUMNS,
)
from kinesia.session import job_settings, shared_dir
from kinesia.sinks.files import write_csv, write_outputs
from kinesia.sinks.kafka import kafka_payload
from kinesia.sources.csv import read_csv, read_csv_stream
from kinesia.sources.imu_view import event_seconds, event_seconds_sql, imu_from_events, imu_view_sql
from kinesia.sources.models import load_pipeline, load_scaler
from kinesia.sources.parquet import read_features, read_parquet_stream
from kinesia.streaming.late import BucketStream
from kinesia.streaming.runner import await_all, latest_rows, parquet_batches, start_outputs
from kinesia.streaming.windows import stream_bucketed_mean

SMOKE_DIR = "/root/testdata/sf0.001"
DAY_TICKS = 86_400 * 100  # one-day buckets: the events table has ~1 row per user per 10 h
DIGITS = 6
BUCKET_DIGITS = 4  # sums of seconds, added in any order
FILL_SEGMENT_S = 2 * 86_400.0
FILL_MAX_AGE_S = 3 * 86_400.0
LEAST_TREND, MOST_ALIKE = 0.056, 0.99
TREE_DEPTH, TREE_BINS = 3, 16
EVENTS_KEYS = ["user_id", "event_type", "bucket"]
STANDARDIZED_DIMS = 64  # the vectors of the embeddings table, whole


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """One task per core: the given tables have one row group and so one scan task each."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _lateness(spark: SparkSession, sf_dir: str) -> str:
    """The time span of the events: staged files arrive in any order, and no row may be late."""
    seconds = event_seconds()
    span = _table(spark, sf_dir, "events").agg(F.max(seconds) - F.min(seconds)).first()[0]
    return f"{int(span or 0) + 1} seconds"


def _files_per_trigger(spark: SparkSession) -> int:
    """Files of a micro-batch: half the cores, so that the staged files (one a core) come as two batches."""
    return max(2, spark.sparkContext.defaultParallelism // 2)


def _imu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imu_from_events(_spread(_table(spark, sf_dir, "events")))


def _rounded(df: DataFrame, cols, digits: int = DIGITS) -> DataFrame:
    """Cast the listed columns to double and round them; keep the rest as is."""
    wanted = set(cols)
    return df.select(
        *[F.round(F.col(c).cast("double"), digits).alias(c) if c in wanted else F.col(c) for c in df.columns]
    )


def _as_double(df: DataFrame, cols) -> DataFrame:
    wanted = set(cols)
    return df.select(*[F.col(c).cast("double").alias(c) if c in wanted else F.col(c) for c in df.columns])


def _stage_stream_input(spark: SparkSession, sf_dir: str, purpose: str) -> str:
    """Land the IMU view as header-less CSV files, as a device gateway would."""
    path = shared_dir(spark, purpose)
    write_csv(_imu(spark, sf_dir), path, header=False)
    return path


def _job(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with the library's settings for what it runs before it returns."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with job_settings(spark):
            return query(spark, sf_dir)

    return run


# ---------------------------------------------------------------- queries


def q_preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = preprocess(_imu(spark, sf_dir), bucket_ticks=DAY_TICKS)
    return _rounded(out, ["timestamp", *FEATURES])


def q_preprocess_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job with the reference's own bucket: round(100 Hz / 9 Hz) = 11 ticks (0.11 s)."""
    out = preprocess(_imu(spark, sf_dir), imu_freq_hz=IMU_FREQ_HZ, hr_freq_hz=HR_FREQ_HZ)
    return _rounded(out, ["timestamp", *FEATURES])


def _events_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events")
    return ev.select(
        "user_id",
        "event_type",
        bucket_index(time_tick(event_seconds()), DAY_TICKS).alias("bucket"),
        event_seconds().alias("timestamp"),
        "value",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
    )


def _q_bucket(how: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = multi_agg(_events_bucketed(spark, sf_dir), EVENTS_KEYS, how=how)
        return _rounded(out, ["timestamp", "value", "k"], BUCKET_DIGITS)

    return run


def q_vector_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _spread(_table(spark, sf_dir, "lineitem"))
    return li.select(
        "l_orderkey", "l_linenumber", magnitude("l_quantity", "l_discount", "l_tax").cast("double").alias("magnitude")
    )


def q_time_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events")
    tick = time_tick("value")
    return ev.select("event_id", tick.alias("tick"), bucket_index(tick, bucket_width(100, 9)).alias("bucket"))


def q_concat_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    imu = _imu(spark, sf_dir)
    return imu.select(
        "timestamp",
        composite_key("user_id", "activity_id").alias("user_activity"),
        joined_values(*MEASUREMENT_COLUMNS).alias("joined"),
    )


def q_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(_table(spark, sf_dir, "events"), "user_id", "event_type")


def q_sentinel_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    imu = _imu(spark, sf_dir)
    return imu.select(
        "timestamp",
        "user_id",
        to_int("heart_rate").alias("heart_rate"),
        sentinel_to_null("chest_gyroscope_z").alias("chest_gyroscope_z"),
    )


def q_drop_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_empty_rows(_imu(spark, sf_dir)).select("timestamp", "user_id", "activity_id", "heart_rate")


def _magnitudes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_magnitudes(drop_empty_rows(_imu(spark, sf_dir)))


def q_imu_magnitudes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(_magnitudes(spark, sf_dir), METRICS)


def q_drop_any_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(drop_incomplete(_magnitudes(spark, sf_dir)), METRICS)


def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(drop_empty_rows(_imu(spark, sf_dir)))


def q_keep_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_key(_table(spark, sf_dir, "events"), "event_type", "click").select("event_id", "user_id")


def q_drop_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_key(_table(spark, sf_dir, "events"), "event_type", "click").select("event_id", "event_type")


def q_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.lit("order").alias("kind")
    )
    customers = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.lit("customer").alias("kind")
    )
    return union_all(orders, customers)


def q_sort_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return sort_by(orders, "o_orderdate", "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return preview(orders, 20, order=[F.col("o_totalprice").desc(), F.col("o_orderkey")])


def q_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = _table(spark, sf_dir, "embeddings")
    vec = emb.select("vec_id", array_to_vector(F.slice("embedding", 1, STANDARDIZED_DIMS)).alias("raw"))
    _, scaled = standardize(vec, "raw", "scaled")
    arr = scaled.select("vec_id", vector_to_array("scaled").alias("s"))
    return arr.select("vec_id", *[F.round(F.col("s")[i], DIGITS).alias(f"s{i}") for i in range(STANDARDIZED_DIMS)])


def q_label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("string").alias("label_text"))
    model = fit_labels(emb, "label_text", "label_index")
    return model.transform(emb).select("vec_id", "label_text", F.col("label_index").cast("bigint"))


def q_category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_tax")
    vec = assembler(["l_linenumber", "l_tax"], "raw").transform(li)
    model = category_indexer("raw", "idx", max_categories=10).fit(vec)
    arr = model.transform(vec).select("l_orderkey", "l_linenumber", vector_to_array("idx").alias("i"))
    return arr.select(
        "l_orderkey",
        "l_linenumber",
        F.col("i")[0].cast("bigint").alias("idx_linenumber"),
        F.col("i")[1].cast("bigint").alias("idx_tax"),
    )


def q_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events")
    side = F.when(split_position("event_id") < F.lit(0.9), F.lit("train")).otherwise(F.lit("test"))
    return ev.select("event_id", side.alias("split"))


def q_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = accuracy_frame(_table(spark, sf_dir, "labels"), label_col="quality", prediction_col="toxic")
    return _rounded(out, ["accuracy"])


def _train_on_events(spark: SparkSession, sf_dir: str):
    buckets = preprocess(_imu(spark, sf_dir), bucket_ticks=DAY_TICKS, ordered=False)
    return train(buckets, seed=1, cut_lineage=True)


def q_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _train_on_events(spark, sf_dir)
    return _rounded(hold_out_results(result.predictions).drop("nonScaledFeatures"), FEATURES)


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "csv-roundtrip")
    write_csv(_imu(spark, sf_dir), path, header=True)
    return read_csv(spark, path)


def q_preprocess_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job as deployed: raw CSV with header (S1) -> J1 -> Parquet (K1)."""
    raw, out = shared_dir(spark, "job-raw-csv"), shared_dir(spark, "job-buckets")
    write_csv(_imu(spark, sf_dir), raw, header=True)
    preprocess_job(spark, raw, out, bucket_ticks=DAY_TICKS)
    return _rounded(spark.read.parquet(out), ["timestamp", *FEATURES])


def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "parquet-roundtrip")
    write_outputs([preprocess(_imu(spark, sf_dir), bucket_ticks=DAY_TICKS, ordered=False)], [path])
    return _rounded(read_features(spark, path), FEATURES)


def q_stream_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _stage_stream_input(spark, sf_dir, "stream-identity-in")
    out, ckpt = shared_dir(spark, "stream-identity-out"), shared_dir(spark, "stream-identity-ckpt")
    stream = passthrough(read_csv_stream(spark, landing, max_files_per_trigger=_files_per_trigger(spark)))

    def writer(df, i):
        return df.writeStream.format("parquet").outputMode("append").option("path", out)

    await_all(start_outputs([stream], writer, ckpt, available_now=True))
    return _as_double(spark.read.parquet(out), MEASUREMENT_COLUMNS)


def _stream_buckets(spark: SparkSession, sf_dir: str, frame_of) -> DataFrame:
    landing = _stage_stream_input(spark, sf_dir, "stream-buckets-in")
    out, ckpt = shared_dir(spark, "stream-buckets-out"), shared_dir(spark, "stream-buckets-ckpt")
    stream = frame_of(read_csv_stream(spark, landing, max_files_per_trigger=_files_per_trigger(spark)))

    def writer(df, i):
        return df.writeStream.outputMode("update").foreachBatch(parquet_batches(out))

    await_all(start_outputs([stream], writer, ckpt, available_now=True))
    return latest_rows(spark, out, ["user_id", "activity_id", "bucket"]).drop("bucket")


@_job
def q_stream_preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    lateness = _lateness(spark, sf_dir)

    def frame_of(stream: DataFrame) -> DataFrame:
        return stream_preprocess(stream, bucket_ticks=DAY_TICKS, watermark=lateness, with_bucket=True)

    out = _stream_buckets(spark, sf_dir, frame_of)
    return _rounded(out.select(*OUTPUT_COLUMNS), ["timestamp", *FEATURES])


@_job
def q_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, lateness = _train_on_events(spark, sf_dir).model, _lateness(spark, sf_dir)

    def frame_of(stream: DataFrame) -> DataFrame:
        scored = score_stream(stream, model, bucket_ticks=DAY_TICKS, watermark=lateness, with_bucket=True)
        return scored.select(*OUTPUT_COLUMNS, "bucket", "predictedLabel")

    out = _stream_buckets(spark, sf_dir, frame_of)
    return _rounded(out, ["timestamp", *FEATURES])


LATENESS_S = 2 * 86_400.0
LANDINGS = 6
MOVED_EVERY, MOVED_BY = 7, 2  # every 7th event lands two slices after its time
ROWS_PER_FILE = 10_000  # of a slice: from there on it lands as several files, at most one a core


def _staged_slices(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """(folder of the events by the slice they land in, files of a slice).

    In time order but for some readings that come much later. Staged once, spread over the cores:
    each landing reads its own slice, not the whole table again.
    """
    events = _table(spark, sf_dir, "events").withColumn("_at", event_seconds())
    span = events.agg(F.min("_at").alias("a"), F.max("_at").alias("b"), F.count(F.lit(1)).alias("n")).first()
    position = F.floor((F.col("_at") - F.lit(span["a"])) * LANDINGS / F.lit(max(span["b"] - span["a"], 1.0) * 1.0001))
    moved = F.when(F.col("event_id") % MOVED_EVERY == 0, MOVED_BY).otherwise(0)
    placed = events.withColumn("_slice", F.least(position + moved, F.lit(LANDINGS - 1)))
    path = shared_dir(spark, "slices")
    _spread(placed).write.partitionBy("_slice").parquet(path)
    return path, min(spark.sparkContext.defaultParallelism, 1 + span["n"] // (LANDINGS * ROWS_PER_FILE))


def _land_out_of_order(spark: SparkSession, staged: str, files: int, landing: str, slices) -> None:
    """Land slices of the IMU view one after the other, each as ``files`` files of about the same size."""
    placed = spark.read.parquet(staged)
    for k in slices:
        imu_from_events(placed.where(F.col("_slice") == k).repartition(files)).write.mode("append").csv(landing, header=False)


@_job
def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 in append mode with two days' lateness over files out of time order: late readings are merged in."""
    landing, out = shared_dir(spark, "late-landing"), shared_dir(spark, "late-tables")
    tables = BucketStream(spark, out, DAY_TICKS, LATENESS_S)
    staged, files = _staged_slices(spark, sf_dir)
    for half in (range(LANDINGS // 2), range(LANDINGS // 2, LANDINGS)):
        _land_out_of_order(spark, staged, files, landing, half)
        tables.run(read_csv_stream(spark, landing, max_files_per_trigger=files))
    return _rounded(tables.merged(), ["timestamp", *FEATURES])


def _past_first_batch(query: StreamingQuery) -> bool:
    """A second micro-batch has ended, or there is none."""
    progress = query.lastProgress
    return progress is not None and (progress["batchId"] >= 1 or not query.status["isDataAvailable"])


@_job
def q_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: the same stream, stopped while its files are being read and resumed from its checkpoints."""
    landing, out = shared_dir(spark, "restart-landing"), shared_dir(spark, "restart-tables")
    tables = BucketStream(spark, out, DAY_TICKS, LATENESS_S)
    staged, files = _staged_slices(spark, sf_dir)
    _land_out_of_order(spark, staged, files, landing, range(LANDINGS))
    first = tables.route(read_csv_stream(spark, landing, max_files_per_trigger=files), available_now=False)
    while first.isActive and not _past_first_batch(first):
        first.awaitTermination(0.2)
    first.stop()  # in whatever step the next micro-batch is
    tables.run(read_csv_stream(spark, landing, max_files_per_trigger=2 * files))
    return _rounded(tables.merged(), ["timestamp", *FEATURES])


SPLIT_KEY, TRAIN_SEED = "user_number", 1
_RUNS: dict[tuple, tuple] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make):
    """What ``make`` gives, once per session and table folder: several queries look at one job's artifacts."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _RUNS:
        _RUNS[key] = make()
    return _RUNS[key]


def _job_artifacts(spark: SparkSession, sf_dir: str) -> tuple:
    """(buckets folder, artifacts folder, model in memory) of the batch jobs as deployed: raw CSV -> J1 -> J2."""

    def make() -> tuple:
        raw, buckets, keyed, out = (shared_dir(spark, f"job-{x}") for x in ("csv", "means", "keyed", "artifacts"))
        write_csv(_imu(spark, sf_dir), raw, header=True)
        preprocess_job(spark, raw, buckets, bucket_ticks=DAY_TICKS, ordered=False)
        rounded = _rounded(spark.read.parquet(buckets), ["timestamp", *FEATURES])
        write_outputs([rounded.withColumn(SPLIT_KEY, F.col("user_id").cast("bigint"))], [keyed])
        return keyed, out, train_job(spark, keyed, out, split_key=SPLIT_KEY, seed=TRAIN_SEED).model

    return _once(spark, sf_dir, "artifacts", make)


@_job
def q_train_job_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored hold-out rows, by users, read back."""
    _, out, _ = _job_artifacts(spark, sf_dir)
    return spark.read.parquet(f"{out}/test_results").select(SPLIT_KEY, LABEL, *FEATURES)


@_job
def q_scaler_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: the stored scaler, fitted on the training users, applied to all buckets."""
    keyed, out, _ = _job_artifacts(spark, sf_dir)
    buckets = assembler(FEATURES).transform(spark.read.parquet(keyed))
    arr = load_scaler(f"{out}/scaler").transform(buckets).withColumn("s", vector_to_array("features"))
    return arr.select("timestamp", "user_id", LABEL, *[F.round(F.col("s")[i], DIGITS).alias(f) for i, f in enumerate(FEATURES)])


@_job
def q_model_reload_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bucket scored by the stored pipeline and by the one in memory."""
    keyed, out, model = _job_artifacts(spark, sf_dir)
    buckets = spark.read.parquet(keyed).select("timestamp", "user_id", LABEL, *FEATURES)
    both = buckets.withColumn("label_kept", F.col(LABEL))
    for name, m in (("stored", load_pipeline(f"{out}/model")), ("held", model)):
        scored = scoring_model(m).transform(both)
        both = scored.select(*both.columns, F.struct("predictedLabel", "probability").alias(name))
    known = F.col("stored.predictedLabel").isin(*model.stages[-1].getLabels())
    return both.select("timestamp", "user_id", LABEL, (F.col("stored") == F.col("held")).alias("same"), known.alias("known_label"))


@_job
def q_stream_score_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets scored on a stream by the stored pipeline, against the batch scores of the one in memory."""
    _, out, model = _job_artifacts(spark, sf_dir)
    landing, target = _stage_stream_input(spark, sf_dir, "score-in"), shared_dir(spark, "score-out")
    stream_job(
        spark, landing, shared_dir(spark, "score-ckpt"), model_path=f"{out}/model", max_files_per_trigger=_files_per_trigger(spark),
        bucket_ticks=DAY_TICKS, watermark=_lateness(spark, sf_dir), sink="files", paths=[target], output_mode="update", available_now=True,
    )
    streamed = latest_rows(spark, f"{target}/rows", ["user_id", "activity_id", "bucket"])
    means = shared_dir(spark, "score-means")
    write_outputs([preprocess(_imu(spark, sf_dir), bucket_ticks=DAY_TICKS, ordered=False)], [means])
    batch = scoring_model(model).transform(spark.read.parquet(means))
    keys = ["timestamp", "user_id", LABEL]
    scores = batch.select(*keys, F.col("predictedLabel").alias("batch_label"))
    joined = streamed.select(*keys, "predictedLabel").join(scores, keys, "full")
    return _rounded(joined.select(*keys, F.col("predictedLabel").eqNullSafe(F.col("batch_label")).alias("same")), ["timestamp"])


def _two_outputs(spark: SparkSession, sf_dir: str) -> tuple:
    """One landing folder, two outputs of one job: the rows as they came, and the bucket means."""

    def make() -> tuple:
        landing, ckpt = _stage_stream_input(spark, sf_dir, "two-in"), shared_dir(spark, "two-ckpt")
        paths = [shared_dir(spark, "two-rows"), shared_dir(spark, "two-means")]
        stream = read_csv_stream(spark, landing, max_files_per_trigger=_files_per_trigger(spark))
        means = stream_preprocess(stream, bucket_ticks=DAY_TICKS, watermark=_lateness(spark, sf_dir), with_bucket=True)
        run_stream(spark, [passthrough(stream), means], ckpt, sink="files", paths=paths, output_mode="update", available_now=True)
        return tuple(f"{p}/rows" for p in paths)

    return _once(spark, sf_dir, "two-outputs", make)


@_job
def q_stream_two_outputs_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _two_outputs(spark, sf_dir)
    return _as_double(spark.read.parquet(rows).drop("_batch_id"), MEASUREMENT_COLUMNS)


@_job
def q_stream_two_outputs_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, means = _two_outputs(spark, sf_dir)
    merged = latest_rows(spark, means, ["user_id", "activity_id", "bucket"])
    return _rounded(merged.select(*OUTPUT_COLUMNS), ["timestamp", *FEATURES])


EVENTS_STREAM_OUTPUT = ("timestamp", "user_id", "event_type", "value", "k")


def q_stream_bucket_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 on the events table read as a Parquet stream: day-window means per user and type."""
    schema, lateness = _table(spark, sf_dir, "events").schema, _lateness(spark, sf_dir)
    stream = read_parquet_stream(spark, sf_dir, schema, file_glob="events.parquet")
    timed = stream.select(
        "user_id",
        "event_type",
        event_seconds().alias("timestamp"),
        "value",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
    )
    frame = stream_bucketed_mean(
        timed,
        DAY_TICKS,
        watermark=lateness,
        keys=("user_id", "event_type"),
        measures=("value", "k"),
        output=EVENTS_STREAM_OUTPUT,
        with_bucket=True,
    )
    out, ckpt = shared_dir(spark, "stream-events-out"), shared_dir(spark, "stream-events-ckpt")

    def writer(df, i):
        return df.writeStream.outputMode("update").foreachBatch(parquet_batches(out))

    await_all(start_outputs([frame], writer, ckpt, available_now=True))
    merged = latest_rows(spark, out, ["user_id", "event_type", "bucket"])
    return _rounded(merged, ["timestamp", "value", "k"])


def q_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 over all readings: missing values carried across two-day segments of each (user, activity)."""
    out = fill_readings(_imu(spark, sf_dir), segment_seconds=FILL_SEGMENT_S, complete=False)
    return _rounded(out, FEATURES)


def q_fill_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 as the preprocessing job: readings of at most three days ago fill, incomplete rows go."""
    out = fill_readings(_imu(spark, sf_dir), segment_seconds=FILL_SEGMENT_S, max_age=FILL_MAX_AGE_S)
    return _rounded(out, FEATURES)


def _bucket_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bucket means, rounded and staged: what follows reads them several times."""
    path = shared_dir(spark, "bucket-means")
    out = preprocess(_imu(spark, sf_dir), bucket_ticks=DAY_TICKS, ordered=False)
    write_outputs([_rounded(out, ["timestamp", *FEATURES])], [path])
    return spark.read.parquet(path)


def q_correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(correlations(_bucket_means(spark, sf_dir), FEATURES), ["correlation"])


def q_correlation_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prune_features(
        _bucket_means(spark, sf_dir), METRICS, target="heart_rate", label=LABEL, least_trend=LEAST_TREND, most_alike=MOST_ALIKE
    )
    rows = [(p.feature, p.target_correlation, p.label_ratio, p.kept) for p in found]
    return spark.createDataFrame(rows, "feature string, target_correlation double, label_ratio double, kept boolean")


def q_signature_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = flag_outliers(_bucket_means(spark, sf_dir), FEATURES, [LABEL])
    return _rounded(out.select("timestamp", "user_id", LABEL, "cosine", "outlier"), ["cosine"])


def q_signature_likeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(group_likeness(_bucket_means(spark, sf_dir)), ["cosine"])


def q_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = _bucket_means(spark, sf_dir)
    tree = fit_tree(buckets, FEATURES, LABEL, max_depth=TREE_DEPTH, bins=TREE_BINS)
    return tree.transform(buckets).select("timestamp", "user_id", LABEL, tree.leaf().alias("leaf"), "predictedLabel")


def q_kafka_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole row as the message."""
    return kafka_payload(_table(spark, sf_dir, "events"), "user_id")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the preprocessing job on the IMU view of sf0.001 events."""
    return q_preprocess(spark, SMOKE_DIR)


def _llm():
    """The training-data operators' queries, if that subpackage is there."""
    try:
        from kinesia.llm import queries as llm_queries

        llm_queries.queries()
    except ImportError:
        return None
    return llm_queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    return {
        "preprocess": q_preprocess,
        "preprocess_default": q_preprocess_default,
        "bucket_avg": _q_bucket("avg"),
        "bucket_sum": _q_bucket("sum"),
        "bucket_max": _q_bucket("max"),
        "vector_magnitude": q_vector_magnitude,
        "time_tick": q_time_tick,
        "concat_key": q_concat_key,
        "distinct_keys": q_distinct_keys,
        "sentinel_to_null": q_sentinel_to_null,
        "drop_empty_rows": q_drop_empty_rows,
        "imu_magnitudes": q_imu_magnitudes,
        "drop_any_null": q_drop_any_null,
        "row_count": q_row_count,
        "keep_key": q_keep_key,
        "drop_key": q_drop_key,
        "union_all": q_union_all,
        "sort_result": q_sort_result,
        "preview": q_preview,
        "standardize": q_standardize,
        "label_index": q_label_index,
        "category_index": q_category_index,
        "hash_split": q_hash_split,
        "accuracy": q_accuracy,
        "train_score": q_train_score,
        "csv_roundtrip": q_csv_roundtrip,
        "preprocess_job": q_preprocess_job,
        "parquet_roundtrip": q_parquet_roundtrip,
        "stream_identity": q_stream_identity,
        "stream_preprocess": q_stream_preprocess,
        "stream_score": q_stream_score,
        "stream_bucket_avg": q_stream_bucket_avg,
        "stream_late_rows": q_stream_late_rows,
        "stream_restart": q_stream_restart,
        "train_job_results": q_train_job_results,
        "scaler_reload": q_scaler_reload,
        "model_reload_score": q_model_reload_score,
        "stream_score_reload": q_stream_score_reload,
        "stream_two_outputs_rows": q_stream_two_outputs_rows,
        "stream_two_outputs_means": q_stream_two_outputs_means,
        "kafka_payload": q_kafka_payload,
        "forward_fill": q_forward_fill,
        "fill_readings": q_fill_readings,
        "correlation_matrix": q_correlation_matrix,
        "correlation_prune": q_correlation_prune,
        "signature_outliers": q_signature_outliers,
        "signature_likeness": q_signature_likeness,
        "tree_score": q_tree_score,
        **(llm.queries() if llm else {}),
    }


# ---------------------------------------------------------------- oracle SQL


def _empty_sql() -> str:
    return " AND ".join(f"({c} IS NULL OR {c} = '{MISSING}')" for c in MEASUREMENT_COLUMNS)


def _dec(expr: str, p: int, s: int) -> str:
    """double -> decimal(p,s) rounding half-up on the shortest decimal text, as Spark does."""
    return f"TRY_CAST(CAST({expr} AS VARCHAR) AS DECIMAL({p},{s}))"


def _magnitude_sql(x: str, y: str, z: str, to_decimal=lambda c: f"TRY_CAST({c} AS DECIMAL(15,10))") -> str:
    x, y, z = to_decimal(x), to_decimal(y), to_decimal(z)
    squares = f"CAST(CAST({x}*{x} + {y}*{y} + {z}*{z} AS VARCHAR) AS DOUBLE)"
    return _dec(f"sqrt({squares})", 15, 10)


def _hr_sql(col: str = "heart_rate") -> str:
    return f"TRY_CAST(trunc(TRY_CAST(NULLIF({col}, '{MISSING}') AS DOUBLE)) AS INTEGER)"


def _round(expr: str, digits: int = DIGITS) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits})"


def _reduced_sql() -> str:
    """CTEs: IMU view, F1, P11 + P14 (as ``reduced``, with the tick)."""
    mags = ",\n    ".join(f"{_magnitude_sql(*(f'{m}_{a}' for a in AXES))} AS {m}" for m in METRICS)
    return f"""imu AS ({imu_view_sql()}),
kept AS (SELECT * FROM imu WHERE NOT ({_empty_sql()})),
reduced AS (
  SELECT timestamp, user_id, activity_id,
    {_hr_sql()} AS heart_rate,
    {mags},
    CAST(round(timestamp * 100) AS BIGINT) AS tick
  FROM kept)"""


def _buckets_sql(width: int = DAY_TICKS) -> str:
    avgs = ",\n    ".join(f"avg({c}) AS {c}" for c in FEATURES)
    outs = ", ".join(
        [f"{_round(_dec('timestamp', 10, 2))} AS timestamp", "user_id", "activity_id"]
        + [f"{_round(c)} AS {c}" for c in FEATURES]
    )
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in OUTPUT_COLUMNS)
    return f"""WITH {_reduced_sql()},
agg AS (
  SELECT user_id, activity_id, CAST(trunc(tick / {width}) AS BIGINT) AS bucket,
    avg(timestamp) AS timestamp,
    {avgs}
  FROM reduced
  WHERE user_id IS NOT NULL AND activity_id IS NOT NULL
  GROUP BY user_id, activity_id, CAST(trunc(tick / {width}) AS BIGINT)),
buckets AS (SELECT {outs} FROM agg WHERE {not_null})"""


def sql_preprocess(width: int = DAY_TICKS) -> str:
    return f"{_buckets_sql(width)}\nSELECT * FROM buckets"


def _sql_bucket(how: str) -> str:
    bucket = f"CAST(round({event_seconds_sql()} * 100) AS BIGINT) // {DAY_TICKS}"
    return f"""WITH e AS (
  SELECT user_id, event_type, {bucket} AS bucket, {event_seconds_sql()} AS seconds, value,
    TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)
SELECT user_id, event_type, bucket, {_round(f'{how}(seconds)', BUCKET_DIGITS)} AS timestamp,
  {_round(f'{how}(value)', BUCKET_DIGITS)} AS value, {_round(f'{how}(k)', BUCKET_DIGITS)} AS k
FROM e GROUP BY user_id, event_type, bucket"""


def _sql_stream_events() -> str:
    seconds = event_seconds_sql()
    bucket = f"CAST(round({seconds} * 100) AS BIGINT) // {DAY_TICKS}"
    return f"""WITH e AS (
  SELECT user_id, event_type, {bucket} AS bucket, {seconds} AS seconds, value,
    TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)
SELECT user_id, event_type, bucket, {_round(_dec('avg(seconds)', 10, 2))} AS timestamp,
  {_round('avg(value)')} AS value, {_round('avg(k)')} AS k
FROM e GROUP BY user_id, event_type, bucket"""


def _imu_select(cols: str, where: str = "") -> str:
    return f"WITH imu AS ({imu_view_sql()})\nSELECT {cols} FROM imu {where}"


def _magnitude_cols_sql() -> str:
    return ", ".join(
        ["timestamp", "activity_id", "heart_rate", "user_id"] + [f"CAST({m} AS DOUBLE) AS {m}" for m in METRICS]
    )


def _lineitem_magnitude_sql() -> str:
    to_dec = lambda c: _dec(c, 15, 10)  # noqa: E731 - doubles go through their shortest text, as in Spark
    return _magnitude_sql("l_quantity", "l_discount", "l_tax", to_dec)


def _category_sql(col: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY ({col} = 0) DESC, {col}) - 1 AS BIGINT)"


def _standardize_sql() -> str:
    cols = []
    for i in range(STANDARDIZED_DIMS):
        x = f"CAST(embedding[{i + 1}] AS DOUBLE)"
        cols.append(f"round(({x} - avg({x}) OVER ()) / stddev_samp({x}) OVER (), {DIGITS}) AS s{i}")
    return f"SELECT vec_id, {', '.join(cols)} FROM embeddings"


def _split_sql() -> str:
    pos = f"((CAST(event_id AS DECIMAL(20,0)) + 0) * {HASH_MULTIPLIER}) % {HASH_MODULUS}"
    return f"SELECT event_id, CASE WHEN {pos} / {HASH_MODULUS}.0 < 0.9 THEN 'train' ELSE 'test' END AS split FROM events"


def _stream_typed_sql() -> str:
    cols = ["timestamp", "activity_id", "user_id", "CAST(TRY_CAST(heart_rate AS DECIMAL(10,2)) AS DOUBLE) AS heart_rate"]
    cols += [f"CAST(TRY_CAST({c} AS DECIMAL(15,10)) AS DOUBLE) AS {c}" for c in MEASUREMENT_COLUMNS[1:]]
    return _imu_select(", ".join(cols))


def _held_out_sql() -> str:
    pos = f"((CAST(user_id AS DECIMAL(20,0)) + {TRAIN_SEED}) * {HASH_MULTIPLIER}) % {HASH_MODULUS}"
    return f"""{_buckets_sql()},
keyed AS (SELECT *, CAST(user_id AS BIGINT) AS {SPLIT_KEY}, {pos} / {HASH_MODULUS}.0 < 0.9 AS training FROM buckets)"""


def _scaler_sql() -> str:
    cols = ", ".join(f"round(({f} - (SELECT avg({f}) FROM keyed WHERE training)) / (SELECT stddev_samp({f}) FROM keyed WHERE training), {DIGITS}) AS {f}" for f in FEATURES)
    return f"{_held_out_sql()}\nSELECT timestamp, user_id, activity_id, {cols} FROM keyed"


def _fill_sql(max_age: float | None, complete: bool) -> str:
    order = "PARTITION BY user_id, activity_id ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    cols = []
    for c in FEATURES:
        last = f"last_value({c} IGNORE NULLS) OVER w"
        if max_age is not None:
            at = f"last_value(CASE WHEN {c} IS NOT NULL THEN timestamp END IGNORE NULLS) OVER w"
            last = f"CASE WHEN timestamp - {at} <= {max_age} THEN {last} END"
        cols.append(f"{_round(last)} AS {c}")
    where = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES) if complete else "true"
    return f"""WITH {_reduced_sql()},
filled AS (SELECT timestamp, user_id, activity_id, {", ".join(cols)} FROM reduced
  WHERE user_id IS NOT NULL AND activity_id IS NOT NULL AND timestamp IS NOT NULL WINDOW w AS ({order}))
SELECT * FROM filled WHERE {where}"""


def _corr_sql(a: str, b: str) -> str:
    return f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN round(corr({a}, {b}), {DIGITS}) END"


def _correlation_sql() -> str:
    pairs = [
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, count({a} + {b}) AS n, {_corr_sql(a, b)} AS correlation FROM buckets"
        for i, a in enumerate(FEATURES) for b in FEATURES[i + 1 :]
    ]
    return f"{_buckets_sql()}\n" + " UNION ALL ".join(pairs)


def _prune_sql() -> str:
    """The greedy drop as a recursion over the pairs, most alike first."""
    each = " UNION ALL ".join(
        f"SELECT {i} AS i, '{f}' AS feature, {_corr_sql(f, 'heart_rate')} AS r, (SELECT round(sqrt(sum(n * (m - w) * (m - w)) / max(t)), {DIGITS})"
        f" FROM (SELECT count(*) AS n, avg({f}) AS m, (SELECT avg({f}) FROM buckets) AS w, (SELECT var_pop({f}) * count(*) FROM buckets) AS t"
        f" FROM buckets GROUP BY activity_id)) AS eta FROM buckets"
        for i, f in enumerate(METRICS)
    )
    pairs = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, abs({_corr_sql(a, b)}) AS alike FROM buckets" for i, a in enumerate(METRICS) for j, b in enumerate(METRICS) if i < j
    )
    return f"""{_buckets_sql().replace("WITH ", "WITH RECURSIVE ", 1)},
each_feature AS ({each}),
trends AS (SELECT *, greatest(abs(coalesce(r, 0)), coalesce(eta, 0)) AS trend FROM each_feature),
pairs AS ({pairs}),
steps AS (SELECT p.i, p.j, CASE WHEN a.trend < b.trend THEN p.i ELSE p.j END AS loser, row_number() OVER (ORDER BY alike DESC, p.i, p.j) AS step
  FROM pairs p JOIN trends a ON a.i = p.i JOIN trends b ON b.i = p.j WHERE alike >= {MOST_ALIKE}),
gone AS (SELECT CAST(0 AS BIGINT) AS step, coalesce((SELECT list(i) FROM trends WHERE trend < {LEAST_TREND}), CAST([] AS INTEGER[])) AS lost
  UNION ALL SELECT s.step, CASE WHEN list_contains(lost, s.i) OR list_contains(lost, s.j) THEN lost ELSE list_append(lost, s.loser) END
  FROM gone g JOIN steps s ON s.step = g.step + 1),
final AS (SELECT lost FROM gone ORDER BY step DESC LIMIT 1)
SELECT feature, r AS target_correlation, coalesce(eta, 0) AS label_ratio, NOT list_contains(lost, i) AS kept FROM trends, final"""


def _cosine_sql(left, right) -> str:
    length = lambda v: "sqrt(" + " + ".join(f"{x} * {x}" for x in v) + ")"
    dot = " + ".join(f"{a} * {b}" for a, b in zip(left, right))
    return f"CASE WHEN {length(left)} * {length(right)} > 0 THEN ({dot}) / ({length(left)} * {length(right)}) END"


def _outliers_sql(percent: int = 5, fence: float = 1.5) -> str:
    sigs = ", ".join(f"avg({f}) AS sig_{f}" for f in FEATURES)
    value = _cosine_sql([f"b.{f}" for f in FEATURES], [f"sig_{f}" for f in FEATURES])
    return f"""{_buckets_sql()},
sigs AS (SELECT activity_id, {sigs} FROM buckets GROUP BY activity_id),
scored AS (SELECT b.timestamp, b.user_id, b.activity_id, {value} AS cosine FROM buckets b JOIN sigs s ON b.activity_id = s.activity_id),
celled AS (SELECT *, CAST(round(cosine * {GRID}) AS BIGINT) AS cell FROM scored),
cells AS (SELECT activity_id, cell, count(*) AS n FROM celled WHERE cell IS NOT NULL GROUP BY activity_id, cell),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY activity_id ORDER BY cell) AS upto, sum(n) OVER (PARTITION BY activity_id) AS total FROM cells),
marks AS (SELECT activity_id, min(CASE WHEN 100 * upto >= {percent} * total THEN cell END) AS low, min(CASE WHEN 100 * upto >= 50 * total THEN cell END) AS mid
  FROM ranked GROUP BY activity_id)
SELECT timestamp, user_id, c.activity_id, {_round("cosine")} AS cosine, coalesce(cell < floor(low - {fence} * (mid - low)), false) AS outlier
FROM celled c LEFT JOIN marks m ON c.activity_id = m.activity_id"""


def _likeness_sql() -> str:
    sigs = ", ".join(f"avg({f}) AS sig_{f}" for f in FEATURES)
    wide = ", ".join(f"avg(sig_{f}) AS all_{f}" for f in FEATURES)
    value = _cosine_sql([f"sig_{f}" for f in FEATURES], [f"all_{f}" for f in FEATURES])
    return f"""{_buckets_sql()},
own AS (SELECT user_id, activity_id, {sigs} FROM buckets GROUP BY user_id, activity_id),
wide AS (SELECT activity_id, {wide} FROM own GROUP BY activity_id)
SELECT user_id, own.activity_id, {_round(value)} AS cosine FROM own JOIN wide ON own.activity_id = wide.activity_id"""


def _tree_sql() -> str:
    """The tree grown in SQL: equal cells, bins of equal counts, then the purest split of each open node, level by level."""
    rows = " UNION ALL ".join(f"SELECT rid, activity_id AS label, {i} AS f, CAST(round({f} * {SCALE}) AS BIGINT) AS q FROM d" for i, f in enumerate(FEATURES))
    ctes = [
        "d AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY timestamp, user_id, activity_id) AS rid FROM buckets)",
        f"lq AS ({rows})",
        "e AS (SELECT f, min(q) AS a, max(q) AS b FROM lq GROUP BY f)",
        f"c AS (SELECT rid, label, lq.f, CAST(floor(CAST((q - a) * {CELLS} AS DOUBLE) / CAST(b - a + 1 AS DOUBLE)) AS INTEGER) AS cell FROM lq JOIN e ON lq.f = e.f)",
        "h AS (SELECT f, cell, count(*) AS n FROM c GROUP BY f, cell)",
        f"cb AS (SELECT f, cell, (sum(n) OVER (PARTITION BY f ORDER BY cell) - n) * {TREE_BINS} // sum(n) OVER (PARTITION BY f) AS bin FROM h)",
        "m AS MATERIALIZED (SELECT rid, label, c.f, bin FROM c JOIN cb ON c.f = cb.f AND c.cell = cb.cell)",
        "n0 AS (SELECT rid, 1 AS node, true AS open FROM d)",
    ]
    for k in range(TREE_DEPTH):
        ctes += [
            f"h{k} AS (SELECT node, f, bin, label, count(*) AS n FROM m JOIN n{k} x ON m.rid = x.rid WHERE open GROUP BY node, f, bin, label)",
            f"l{k} AS (SELECT c.node, c.f, c.bin, h.label, CAST(coalesce(sum(h.n) FILTER (h.bin <= c.bin), 0) AS BIGINT) AS l, CAST(sum(h.n) AS BIGINT) AS t"
            f" FROM (SELECT DISTINCT node, f, bin FROM h{k}) c JOIN h{k} h ON h.node = c.node AND h.f = c.f GROUP BY c.node, c.f, c.bin, h.label)",
            f"s{k} AS (SELECT node, f, bin, CAST(sum(l * l) AS DOUBLE) / sum(l) + CAST(sum((t - l) * (t - l)) AS DOUBLE) / sum(t - l) AS score,"
            f" CAST(sum(t * t) AS DOUBLE) / sum(t) + {LEAST_GAIN} * sum(t) AS least FROM l{k} GROUP BY node, f, bin HAVING sum(l) > 0 AND sum(t - l) > 0)",
            f"b{k} AS (SELECT node, f, bin FROM s{k} WHERE score > least QUALIFY row_number() OVER (PARTITION BY node ORDER BY score DESC, f, bin) = 1)",
            f"n{k + 1} AS MATERIALIZED (SELECT x.rid, CASE WHEN b.node IS NULL THEN x.node WHEN m.bin <= b.bin THEN 2 * x.node ELSE 2 * x.node + 1 END AS node,"
            f" x.open AND b.node IS NOT NULL AS open FROM n{k} x LEFT JOIN b{k} b ON x.open AND x.node = b.node LEFT JOIN m ON m.rid = x.rid AND m.f = b.f)",
        ]
    last = TREE_DEPTH
    return f"""{_buckets_sql()},
{", ".join(ctes)},
votes AS (SELECT node, activity_id, count(*) AS n FROM n{last} x JOIN d ON x.rid = d.rid GROUP BY node, activity_id),
leaves AS (SELECT node, activity_id AS label FROM votes QUALIFY row_number() OVER (PARTITION BY node ORDER BY n DESC, activity_id) = 1)
SELECT timestamp, user_id, activity_id, CAST(x.node AS BIGINT) AS leaf, label AS "predictedLabel"
FROM d JOIN n{last} x ON d.rid = x.rid JOIN leaves ON leaves.node = x.node"""


def oracle_sql() -> dict[str, str]:
    llm = _llm()
    mag_view = f"""WITH {_reduced_sql()}
SELECT {_magnitude_cols_sql()} FROM reduced"""
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in ["timestamp", "activity_id", "heart_rate", "user_id", *METRICS])
    return {
        "preprocess": sql_preprocess(),
        "preprocess_default": sql_preprocess(bucket_width(IMU_FREQ_HZ, HR_FREQ_HZ)),
        "bucket_avg": _sql_bucket("avg"),
        "bucket_sum": _sql_bucket("sum"),
        "bucket_max": _sql_bucket("max"),
        "vector_magnitude": f"SELECT l_orderkey, l_linenumber, CAST({_lineitem_magnitude_sql()} AS DOUBLE) AS magnitude FROM lineitem",
        "time_tick": """SELECT event_id, CAST(round(value * 100) AS BIGINT) AS tick,
  CAST(trunc(CAST(round(value * 100) AS BIGINT) / 11) AS BIGINT) AS bucket FROM events""",
        "concat_key": _imu_select(
            f"timestamp, user_id || '_' || activity_id AS user_activity, "
            f"concat_ws(',', {', '.join(MEASUREMENT_COLUMNS)}) AS joined"
        ),
        "distinct_keys": "SELECT DISTINCT user_id, event_type FROM events",
        "sentinel_to_null": _imu_select(
            f"timestamp, user_id, {_hr_sql()} AS heart_rate, NULLIF(chest_gyroscope_z, '{MISSING}') AS chest_gyroscope_z"
        ),
        "drop_empty_rows": _imu_select("timestamp, user_id, activity_id, heart_rate", f"WHERE NOT ({_empty_sql()})"),
        "imu_magnitudes": mag_view,
        "drop_any_null": f"SELECT * FROM ({mag_view}) WHERE {not_null}",
        "row_count": _imu_select("count(*) AS n", f"WHERE NOT ({_empty_sql()})"),
        "keep_key": "SELECT event_id, user_id FROM events WHERE event_type = 'click'",
        "drop_key": "SELECT event_id, event_type FROM events WHERE event_type <> 'click'",
        "union_all": """SELECT o_orderkey AS id, o_totalprice AS amount, 'order' AS kind FROM orders
UNION ALL SELECT c_custkey AS id, c_acctbal AS amount, 'customer' AS kind FROM customer""",
        "sort_result": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey",
        "preview": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
        "standardize": _standardize_sql(),
        "label_index": """WITH c AS (SELECT CAST(label AS VARCHAR) AS label_text, count(*) AS n FROM embeddings GROUP BY 1),
r AS (SELECT label_text, CAST(row_number() OVER (ORDER BY n DESC, label_text) - 1 AS BIGINT) AS label_index FROM c)
SELECT e.vec_id, r.label_text, r.label_index FROM embeddings e JOIN r ON CAST(e.label AS VARCHAR) = r.label_text""",
        "category_index": f"""SELECT l_orderkey, l_linenumber, {_category_sql('l_linenumber')} AS idx_linenumber,
  {_category_sql('l_tax')} AS idx_tax FROM lineitem""",
        "hash_split": _split_sql(),
        "accuracy": """SELECT round(avg(CASE WHEN CAST(quality AS DOUBLE) = CAST(toxic AS DOUBLE) THEN 1.0 ELSE 0.0 END), 6)
  AS accuracy, count(*) AS n FROM labels""",
        "csv_roundtrip": imu_view_sql(),
        "preprocess_job": sql_preprocess(),
        "parquet_roundtrip": f"{_buckets_sql()}\nSELECT {', '.join([*FEATURES, LABEL])} FROM buckets",
        "stream_identity": _stream_typed_sql(),
        "stream_preprocess": sql_preprocess(),
        "stream_bucket_avg": _sql_stream_events(),
        "stream_late_rows": sql_preprocess(),
        "stream_restart": sql_preprocess(),
        "train_job_results": f"{_held_out_sql()}\nSELECT {SPLIT_KEY}, {LABEL}, {', '.join(FEATURES)} FROM keyed WHERE NOT training",
        "scaler_reload": _scaler_sql(),
        "model_reload_score": f"{_buckets_sql()}\nSELECT timestamp, user_id, activity_id, true AS same, true AS known_label FROM buckets",
        "stream_score_reload": f"{_buckets_sql()}\nSELECT timestamp, user_id, activity_id, true AS same FROM buckets",
        "stream_two_outputs_rows": _stream_typed_sql(),
        "stream_two_outputs_means": sql_preprocess(),
        "kafka_payload": """SELECT CAST(user_id AS VARCHAR) AS key,
  to_json(struct_pack(event_id := event_id, ts := strftime(ts, '%Y-%m-%dT%H:%M:%S.%g'), user_id := user_id,
    event_type := event_type, value := value, props := props)) AS value
FROM events""",
        "forward_fill": _fill_sql(None, complete=False),
        "fill_readings": _fill_sql(FILL_MAX_AGE_S, complete=True),
        "correlation_matrix": _correlation_sql(),
        "correlation_prune": _prune_sql(),
        "signature_outliers": _outliers_sql(),
        "signature_likeness": _likeness_sql(),
        "tree_score": _tree_sql(),
        **(llm.oracle_sql() if llm else {}),
    }


__all__ = ["entry", "oracle_sql", "queries"]
