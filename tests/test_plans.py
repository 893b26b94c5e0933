"""Plan-shape checks: the properties the design relies on at scale stay true."""

from kinesia.operators import keep_key
from kinesia.plans.preprocess import preprocess
from kinesia.schema import FEATURES, LABEL
from kinesia.session import shared_dir
from kinesia.sinks.files import write_csv
from kinesia.sources.csv import read_csv
from kinesia.sources.imu_view import imu_from_events
from kinesia.sources.parquet import read_features


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _assert_jvm_only(plan: str) -> None:
    assert "BroadcastExchange" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_preprocess_plan_has_two_exchanges_and_partial_aggregation(spark, events):
    raw_dir = shared_dir(spark, "plan-raw")
    write_csv(imu_from_events(events).repartition(4), raw_dir, header=True)
    plan = _plan(preprocess(read_csv(spark, raw_dir), bucket_ticks=8_640_000))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Exchange rangepartitioning") == 1
    assert "partial_avg" in plan
    assert "RoundRobinPartitioning" not in plan  # no redistribution of a multi-file input
    _assert_jvm_only(plan)


def test_unordered_preprocess_has_one_exchange(spark, events):
    plan = _plan(preprocess(imu_from_events(events.repartition(4)), bucket_ticks=8_640_000, ordered=False))
    assert plan.count("Exchange ") == 2  # the test's own repartition + the aggregate's hash exchange
    assert plan.count("Exchange hashpartitioning") == 1
    _assert_jvm_only(plan)


def test_filter_and_projection_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = _plan(keep_key(df, "event_type", "click").select("event_id"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_feature_scan_reads_only_features_and_label(spark, events):
    path = shared_dir(spark, "plan-buckets")
    preprocess(imu_from_events(events), bucket_ticks=8_640_000, ordered=False).write.parquet(path)
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # print the whole schema
    try:
        plan = _plan(read_features(spark, path))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert all(f"{c}:" in schema for c in (*FEATURES, LABEL))
    assert "timestamp" not in schema and "user_id" not in schema
