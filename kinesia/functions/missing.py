"""Missing-value handling: the ``NA`` sentinel, safe casts, the all-missing test."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinesia.schema import MISSING


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_to_null(c: str | Column, sentinel: str = MISSING) -> Column:
    """``NULL`` where the cell equals the sentinel, the cell otherwise."""
    return F.nullif(_col(c), F.lit(sentinel))


def to_int(c: str | Column, sentinel: str = MISSING) -> Column:
    """Sentinel or unparsable text to NULL, otherwise an int truncated toward zero.

    Text goes through double first so ``"100.5"`` becomes 100 as the reference's
    integer cast did; numeric input is cast directly.
    """
    return sentinel_to_null(c, sentinel).try_cast(T.DoubleType()).try_cast(T.IntegerType())


def to_decimal(c: str | Column, precision: int = 15, scale: int = 10) -> Column:
    """Cast to ``decimal(p, s)``; sentinel, garbage and overflow become NULL."""
    return _col(c).try_cast(T.DecimalType(precision, scale))


def missing_cell(c: str | Column, sentinel: str | None = MISSING) -> Column:
    """True for NULL, or for the sentinel when one is given (text columns only)."""
    test = _col(c).isNull()
    if sentinel is not None:
        test = test | (_col(c) == F.lit(sentinel))
    return test


def all_missing(columns: Iterable[str | Column], sentinel: str | None = MISSING) -> Column:
    """True when every given cell is NULL or the sentinel (F1's emptiness test).

    An AND of per-column tests: it short-circuits, stays in codegen and never
    builds the joined string the reference compared against. Typed (non-text)
    columns hold no sentinel: pass them as ``(column, None)`` pairs.
    """
    tests = [
        missing_cell(*c) if isinstance(c, tuple) else missing_cell(c, sentinel) for c in columns
    ]
    if not tests:
        raise ValueError("all_missing needs at least one column")
    return reduce(lambda a, b: a & b, tests)
