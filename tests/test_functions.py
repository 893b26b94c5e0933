import math
import random
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Context, Decimal

import pytest
from pyspark.sql import functions as F

from kinesia.functions import (
    bucket_index,
    bucket_width,
    composite_key,
    joined_values,
    magnitude,
    magnitude_of_doubles,
    sentinel_to_null,
    time_tick,
    to_int,
)


def test_magnitude_golden_value(spark):
    df = spark.createDataFrame([("2.2153", "8.27915", "5.58753")], "x string, y string, z string")
    (value,) = df.select(magnitude("x", "y", "z")).first()
    assert value == Decimal("10.2309515840")
    assert str(df.select(magnitude("x", "y", "z").alias("m")).schema["m"].dataType) == "DecimalType(15,10)"


@pytest.mark.parametrize(
    "row",
    [
        ("NA", "1.0", "2.0"),  # x missing
        ("1.0", "NA", "2.0"),  # y missing: the reference crashed, we give NULL
        ("1.0", "2.0", None),  # NULL cell
        ("junk", "2.0", "3.0"),  # unparsable
        ("90000", "90000", "0"),  # magnitude >= 1e5 overflows decimal(15,10)
    ],
)
def test_magnitude_missing_or_overflow_is_null(spark, row):
    df = spark.createDataFrame([row], "x string, y string, z string")
    assert df.select(magnitude("x", "y", "z")).first()[0] is None


def _reference_model(x: str, y: str, z: str) -> Decimal:
    """Exact decimal squares, double root, 16 significant digits, then 10 places half-up."""
    squares = Decimal(x) ** 2 + Decimal(y) ** 2 + Decimal(z) ** 2
    root = math.sqrt(float(squares))
    sixteen = Context(prec=16, rounding=ROUND_HALF_EVEN).plus(Decimal(root))
    return sixteen.quantize(Decimal("1e-10"), rounding=ROUND_HALF_UP)


def test_magnitude_matches_decimal_model(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(2000):
        rows.append(tuple(f"{rnd.uniform(-80, 80):.{rnd.randint(0, 6)}f}" for _ in range(3)))
    df = spark.createDataFrame(rows, "x string, y string, z string")
    got = df.select("x", "y", "z", magnitude("x", "y", "z").alias("m")).collect()
    worst = max(abs(r.m - _reference_model(r.x, r.y, r.z)) for r in got)
    assert worst <= Decimal("1e-10")


def test_magnitude_of_doubles(spark):
    df = spark.createDataFrame([(3.0, 4.0, 12.0)], "x double, y double, z double")
    assert df.select(magnitude_of_doubles("x", "y", "z")).first()[0] == 13.0


def test_bucket_width_rounds_half_up():
    assert bucket_width(100, 9) == 11
    assert bucket_width(100, 8) == 13  # 12.5 -> 13; Python's round would give 12
    with pytest.raises(ValueError):
        bucket_width(100, 0)


def test_tick_and_bucket_truncate_toward_zero(spark):
    df = spark.createDataFrame([(37.66,), (0.054,), (-0.05,), (-0.15,), (21474837.0,)], "t double")
    rows = df.select(time_tick("t").alias("tick"), bucket_index(time_tick("t"), 11).alias("b")).collect()
    assert [(r.tick, r.b) for r in rows] == [
        (3766, 342),
        (5, 0),
        (-5, 0),
        (-15, -1),
        (2147483700, 195225790),  # past the 32-bit tick range of the reference
    ]


def test_sentinel_and_int_parsing(spark):
    df = spark.createDataFrame([("100",), ("100.5",), ("NA",), ("junk",), (None,)], "hr string")
    rows = df.select(to_int("hr").alias("i"), sentinel_to_null("hr").alias("s")).collect()
    assert [r.i for r in rows] == [100, 100, None, None, None]
    assert [r.s for r in rows] == ["100", "100.5", None, "junk", None]


def test_keys(spark):
    df = spark.createDataFrame([("a", "walk", None), ("b", None, "x")], "u string, a string, c string")
    rows = df.select(composite_key("u", "a").alias("k"), joined_values("u", "a", "c").alias("j")).collect()
    assert [(r.k, r.j) for r in rows] == [("a_walk", "a,walk"), (None, "b,x")]


def test_magnitude_accepts_decimal_columns(spark):
    df = spark.createDataFrame([("2.2153", "8.27915", "5.58753")], "x string, y string, z string").select(
        *[F.col(c).cast("decimal(15,10)").alias(c) for c in "xyz"]
    )
    assert df.select(magnitude("x", "y", "z")).first()[0] == Decimal("10.2309515840")


def test_fast_magnitude_agrees_with_exact(spark):
    rnd = random.Random(11)
    rows = [tuple(f"{rnd.uniform(-500, 500):.{rnd.randint(0, 6)}f}" for _ in range(3)) for _ in range(3000)]
    rows.append(("NA", "1", "2"))
    df = spark.createDataFrame(rows, "x string, y string, z string")
    got = df.select(
        magnitude("x", "y", "z").alias("e"), magnitude("x", "y", "z", exact=False).alias("f")
    ).collect()
    assert all((r.e is None) == (r.f is None) for r in got)
    assert max(abs(r.e - r.f) for r in got if r.e is not None) <= Decimal("1e-10")
