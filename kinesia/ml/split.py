"""Deterministic train/test split (M6).

``randomSplit`` samples each partition with a seeded generator, so the two
halves depend on partition layout and are re-drawn whenever the lineage is
recomputed (lost executor, un-cached input): a row can land in both halves or
in neither. Here a row's side is a pure function of its key, so any task can
be re-run anywhere and every run agrees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Knuth's multiplicative hashing constant and its 32-bit modulus.
HASH_MULTIPLIER = 2654435761
HASH_MODULUS = 4294967296

_INTEGRAL = {"tinyint", "smallint", "int", "bigint"}


def split_position(key: Sequence[str] | str, seed: int = 0, integral: bool | None = None) -> Column:
    """A position in [0, 1) per row from its key.

    A single integral id column is hashed directly (Fibonacci hashing spreads
    consecutive ids evenly); other keys are first combined with ``xxhash64``.
    ``integral`` defaults to "one column given". Decimal arithmetic keeps the
    product exact.
    """
    cols = [key] if isinstance(key, str) else list(key)
    if integral is None:
        integral = len(cols) == 1
    base = F.col(cols[0]) if integral and len(cols) == 1 else F.xxhash64(*cols)
    mixed = (base.cast("decimal(20,0)") + F.lit(seed)) * F.lit(HASH_MULTIPLIER)
    return (F.pmod(mixed, F.lit(HASH_MODULUS)) / F.lit(HASH_MODULUS)).cast("double")


def hash_split(
    df: DataFrame,
    key: Sequence[str] | str,
    train_fraction: float = 0.9,
    seed: int = 0,
    integral: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with about ``train_fraction`` of the rows in train.

    Two filters over the same lineage; no shuffle, no driver step.
    """
    if not 0.0 < train_fraction < 1.0:
        raise ValueError("train_fraction must lie strictly between 0 and 1")
    cols = [key] if isinstance(key, str) else list(key)
    if integral is None:
        integral = len(cols) == 1 and dict(df.dtypes)[cols[0]] in _INTEGRAL
    pos = split_position(cols, seed, integral)
    return df.where(pos < F.lit(train_fraction)), df.where(pos >= F.lit(train_fraction))


def random_split(df: DataFrame, weights: Sequence[float] = (0.9, 0.1), seed: int = 0) -> list[DataFrame]:
    """Spark's seeded ``randomSplit``, for callers that want the reference's sampler."""
    return df.randomSplit(list(weights), seed)
