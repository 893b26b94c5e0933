import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from kinesia.ml.evaluate import accuracy, accuracy_frame
from kinesia.ml.features import assembler, category_indexer, fit_labels, standardize
from kinesia.ml.split import hash_split, split_position
from kinesia.plans.preprocess import preprocess
from kinesia.plans.train import hold_out_results, scoring_model, train
from kinesia.schema import FEATURES
from kinesia.session import shared_dir
from kinesia.sources.imu_view import imu_from_events
from kinesia.sources.models import load_pipeline

DAY = 8_640_000


@pytest.fixture(scope="module")
def buckets(spark, events):
    return preprocess(imu_from_events(events), bucket_ticks=DAY, ordered=False).persist()


def test_standardize_uses_sample_std(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 10.0]),), (Vectors.dense([3.0, 30.0]),)], ["v"])
    _, out = standardize(df, "v", "s")
    vals = sorted(tuple(r.s) for r in out.select(vector_to_array("s").alias("s")).collect())
    half = 2 ** -0.5  # (x - mean) / sample sd with n - 1 = 1
    assert vals[0] == pytest.approx((-half, -half)) and vals[1] == pytest.approx((half, half))


def test_label_order_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([(x,) for x in "bbbaaccd"], "l string")
    model = fit_labels(df, "l")
    assert model.labels == ["b", "a", "c", "d"]


def test_category_indexer_zero_first(spark):
    df = spark.createDataFrame([(0.5, 7.0), (0.0, 3.0), (0.25, 5.0), (0.5, 3.0)], "a double, b double")
    vec = assembler(["a", "b"], "raw").transform(df)
    out = category_indexer("raw", "idx", max_categories=3).fit(vec).transform(vec)
    got = [tuple(r.i) for r in out.select(vector_to_array("idx").alias("i")).collect()]
    assert got == [(2.0, 2.0), (0.0, 0.0), (1.0, 1.0), (2.0, 0.0)]


def test_hash_split_is_deterministic_and_proportional(spark):
    df = spark.range(20000).withColumnRenamed("id", "event_id")
    a_train, a_test = hash_split(df, "event_id", 0.9)
    b_train, b_test = hash_split(df.repartition(7), "event_id", 0.9)
    n_train, n_test = a_train.count(), a_test.count()
    assert n_train + n_test == 20000 and 0.88 < n_train / 20000 < 0.92
    assert a_test.exceptAll(b_test).count() == 0 and b_test.exceptAll(a_test).count() == 0
    multi = df.select(F.col("event_id").cast("string").alias("u"), (F.col("event_id") % 3).alias("a"))
    pos = multi.select(split_position(["u", "a"]).alias("p")).agg(F.min("p"), F.max("p")).first()
    assert 0.0 <= pos[0] < pos[1] < 1.0


def test_accuracy_frame_equals_evaluator(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 2.0), (1.0, 1.0)], "indexedLabel double, prediction double")
    assert accuracy_frame(df).first().accuracy == pytest.approx(accuracy(df)) == pytest.approx(0.75)


def test_train_is_deterministic_and_saves_artifacts(spark, buckets):
    out = shared_dir(spark, "test-train")
    first = train(buckets, seed=3, max_iter=25, out_dir=out)
    second = train(buckets, seed=3, max_iter=25)
    assert first.labels == second.labels and len(first.labels) == 5
    key = ["heart_rate", "wrist_accelerometer", "activity_id"]
    p1 = first.predictions.select(*key, "predictedLabel")
    p2 = second.predictions.select(*key, "predictedLabel")
    assert p1.count() > 0 and p1.exceptAll(p2).count() == 0
    saved = spark.read.parquet(f"{out}/test_results")
    assert set(saved.columns) == {*FEATURES, "activity_id", "nonScaledFeatures", "predictedLabel"}
    assert saved.count() == first.test.count()
    reloaded = load_pipeline(f"{out}/model")
    again = scoring_model(reloaded).transform(first.test).select(*key, "predictedLabel")
    assert again.exceptAll(p1).count() == 0


def test_train_fits_in_sample(spark, buckets):
    result = train(buckets, seed=1, max_iter=200)
    scored = result.model.transform(result.train)
    assert accuracy(scored) > 0.5  # random labels: the network can only memorise
    assert hold_out_results(result.predictions).columns[-1] == "predictedLabel"


def test_train_takes_any_number_of_labels(spark):
    df = spark.range(1100).selectExpr(*[f"CAST(id AS DOUBLE) AS {c}" for c in FEATURES], "CAST(id AS STRING) AS activity_id")
    assert len(train(df, max_iter=1, cut_lineage=True).labels) == 1100


def test_label_index_order_for_activity_labels(spark):
    from kinesia.schema import ACTIVITY_LABELS

    # the most frequent activity gets index 0, as in the reference's saved label list
    rows = [(label,) for i, label in enumerate(ACTIVITY_LABELS) for _ in range(len(ACTIVITY_LABELS) - i)]
    model = fit_labels(spark.createDataFrame(rows, "activity_id string"), "activity_id")
    assert model.labels == list(ACTIVITY_LABELS)


def test_hash_split_on_text_key(spark):
    df = spark.range(1000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user"))
    train_part, test_part = hash_split(df, "user", 0.8)
    assert train_part.count() + test_part.count() == 1000 and 700 < train_part.count() < 900
