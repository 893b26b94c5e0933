"""String keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def composite_key(*cols: str | Column, sep: str = "_") -> Column:
    """``a_b`` style key; NULL if any part is NULL (``concat`` semantics).

    Only for display: ``a_b``+``c`` and ``a``+``b_c`` collide, so grouping uses
    the columns themselves.
    """
    parts: list[Column] = []
    for i, c in enumerate(_cols(cols)):
        if i:
            parts.append(F.lit(sep))
        parts.append(c.cast("string"))
    return F.concat(*parts)


def joined_values(*cols: str | Column, sep: str = ",") -> Column:
    """``concat_ws``: joins the non-NULL values, skipping NULLs."""
    return F.concat_ws(sep, *[c.cast("string") for c in _cols(cols)])
