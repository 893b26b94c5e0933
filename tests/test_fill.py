"""Forward fill (X1): series, segments, age limit, and what belongs to no series."""

import random

import pytest

from kinesia.operators import fill
from kinesia.operators.fill import forward_fill
from kinesia.plans.fill import fill_readings
from kinesia.plans.jobs import preprocess_job
from kinesia.schema import FEATURES, OUTPUT_COLUMNS
from kinesia.session import shared_dir
from kinesia.sinks.files import write_csv
from imu_rows import raw_frame, raw_row

SCHEMA = "timestamp double, user_id string, activity_id string, a double, b string, _fill_segmen int"


def _plain(rows, max_age=None):
    """The fill of (t, user, activity, a, b) rows, series by series, readings of one instant as one."""
    out = []
    for t, u, act, *values in rows:
        filled = []
        for k, v in enumerate(values):
            if v is None and None not in (t, u, act):
                seen = [(r[0], r[3 + k]) for r in rows if r[1:3] == (u, act) and r[0] is not None and r[0] <= t and r[3 + k] is not None]
                at, last = max(seen, default=(None, None))
                v = last if seen and (max_age is None or t - at <= max_age) else None
            filled.append(v)
        out.append((t, u, act, *filled))
    return sorted(out, key=repr)


def _rows(n, seed, users=("u", "v"), span=1000):
    rng = random.Random(seed)
    pick = lambda v: None if rng.random() < 0.6 else v
    return [(round(rng.random() * span, 2) - span / 3, rng.choice(users), rng.choice("xy"), pick(rng.random()), pick(str(rng.randrange(50)))) for _ in range(n)]


def _filled(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r)[:5] for r in forward_fill(df, ["a", "b"], **options).collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"segment_seconds": 50.0}, {"segment_seconds": 7.0, "fan": 3}, {"segment_seconds": 20.0, "max_age": 15.0}])
def test_fill_equals_the_plain_loop(spark, options):
    rows = _rows(300, 1)
    rows += [(None, "u", "x", None, None), (5.0, None, "x", None, "k"), (5.0, "u", None, 1.0, None)]  # of no series
    rows += [(20.0, "u", "x", 3.0, None), (20.0, "u", "x", 4.0, None), (20.0, "u", "x", None, None)] + rows[:5]  # one instant, repeated rows
    assert _filled(spark, rows, **options) == _plain(rows, options.get("max_age"))


def test_one_series_with_all_rows_is_cut(spark, monkeypatch):
    """The width comes from the densest series, and gaps longer than many segments are bridged."""
    rows = [(t, "u", "x", a, b) for t, _, _, a, b in _rows(400, 2)] + [(t + 10**6, "u", "x", None, b) for t, _, _, _, b in _rows(100, 3)]
    monkeypatch.setattr(fill, "SEGMENT_ROWS", 40)
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    width = fill.segment_width(df, ["user_id", "activity_id"], "timestamp", 40)
    assert 0 < width < 10**6
    assert _filled(spark, rows, segment_seconds=width, fan=16) == _plain(rows)
    plan = forward_fill(df, ["a"], segment_seconds=width)._jdf.queryExecution().executedPlan().toString()
    assert "_fill_segment" in plan.split("Window [")[1].split("Sort [")[1].split("]")[0]  # no window over a whole series


def test_short_series_are_not_cut(spark):
    df = spark.createDataFrame([(*r, 1) for r in _rows(50, 4)], SCHEMA)
    assert fill.segment_width(df, ["user_id", "activity_id"], "timestamp") is None
    assert forward_fill(df.limit(0), ["a"], segment_seconds=5.0).count() == 0
    assert forward_fill(df, ["a"]).columns == df.columns and forward_fill(df, ["a"]).dtypes == df.dtypes


def test_fill_job_keeps_every_reading(spark):
    raw = [raw_row(0.01 * i, "walk", "u", hr=str(60 + i) if i % 11 == 0 else "NA") for i in range(40)]
    raw += [raw_row(0.5, "walk", "u", default="NA"), raw_row(0.55, "walk", None), raw_row(9.0, "sit", "u")]
    out = fill_readings(raw_frame(spark, raw))
    assert out.columns == list(OUTPUT_COLUMNS) and out.count() == 40
    assert [r["heart_rate"] for r in out.orderBy("timestamp").collect()] == [60 + i // 11 * 11 for i in range(40)]
    stale = fill_readings(raw_frame(spark, raw), max_age=0.055, complete=False)
    assert stale.where("heart_rate is null").count() == 16 + 1  # more than 5 ticks after a reading; the sitting row
    path, target = shared_dir(spark, "fill-raw"), shared_dir(spark, "fill-out")
    write_csv(raw_frame(spark, raw), path, header=True)
    preprocess_job(spark, path, target, fill=True)
    written = spark.read.parquet(target)
    assert written.count() == 40 and set(FEATURES) <= set(written.columns)
