"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinesia.functions.missing import all_missing
from kinesia.operators.projections import measurement_columns
from kinesia.schema import KEY_COLUMNS, MISSING


def drop_empty_rows(
    df: DataFrame,
    key_columns: Sequence[str] = KEY_COLUMNS,
    sentinel: str = MISSING,
) -> DataFrame:
    """Drop rows whose every measurement is NULL or the sentinel (F1).

    Measurements are all columns except ``key_columns``; only text columns can
    hold the sentinel, typed ones are tested for NULL. A plain predicate, so
    the parquet reader can still push the rest of the plan's filters and the
    whole step stays in one codegen stage with the projection that follows.
    """
    types = dict(df.dtypes)
    cols = [(c, sentinel if types[c] == "string" else None) for c in measurement_columns(df, key_columns)]
    return df.where(~all_missing(cols))


def keep_key(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` equals ``value`` (F2)."""
    return df.where(F.col(column) == F.lit(value))


def drop_key(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` differs from ``value``; NULL keys drop too, as in SQL."""
    return df.where(F.col(column) != F.lit(value))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (or any listed) column."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)
