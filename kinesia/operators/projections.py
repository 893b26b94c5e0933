"""Projections (P1-P4, P14): one ``select`` per step, never chains of ``withColumn``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinesia.functions.magnitude import magnitude
from kinesia.functions.missing import to_int
from kinesia.schema import AXES, KEY_COLUMNS, METRICS, MISSING


def measurement_columns(df: DataFrame, exclude: Sequence[str] = KEY_COLUMNS) -> list[str]:
    """Every column but the excluded ones, in frame order."""
    skip = set(exclude)
    return [c for c in df.columns if c not in skip]


def with_columns(df: DataFrame, columns: dict) -> DataFrame:
    """Add or replace several columns in one projection."""
    return df.withColumns(columns)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; unknown names are ignored."""
    return df.drop(*names)


def select_ordered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Final projection in a fixed order."""
    return df.select(*columns)


def with_magnitudes(
    df: DataFrame,
    metrics: Sequence[str] = METRICS,
    *,
    heart_rate: str | None = "heart_rate",
    sentinel: str = MISSING,
    exact: bool = True,
) -> DataFrame:
    """Replace each metric's ``_x/_y/_z`` columns by its magnitude.

    The result keeps the other columns in place, puts each magnitude where its
    ``_x`` column was and drops ``_y`` and ``_z``. ``heart_rate``, when present,
    becomes an int: text with the sentinel as NULL (P11), typed input truncated.
    One projection.
    """
    axis_cols = {f"{m}_{a}": m for m in metrics for a in AXES}
    types = dict(df.dtypes)
    out = []
    for c in df.columns:
        metric = axis_cols.get(c)
        if metric is None:
            if heart_rate is not None and c == heart_rate:
                text = types[c] == "string"
                hr = to_int(c, sentinel) if text else F.col(c).try_cast(T.IntegerType())
                out.append(hr.alias(c))
            else:
                out.append(F.col(c))
        elif c.endswith("_x"):
            x, y, z = (f"{metric}_{a}" for a in AXES)
            out.append(magnitude(x, y, z, exact=exact).alias(metric))
    missing = [f"{m}_{a}" for m in metrics for a in AXES if f"{m}_{a}" not in df.columns]
    if missing:
        raise ValueError(f"axis columns not found: {missing}")
    return df.select(*out)
