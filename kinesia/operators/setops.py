"""Union, sort, preview and output partitioning."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def union_all(*frames: DataFrame, by_name: bool = True) -> DataFrame:
    """Bag union of any number of frames.

    By name by default: the reference's positional union silently mixes
    columns when two producers order them differently. No shuffle.
    """
    if not frames:
        raise ValueError("union_all needs at least one frame")
    if by_name:
        return reduce(lambda a, b: a.unionByName(b), frames)
    return reduce(lambda a, b: a.union(b), frames)


def sort_by(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Global sort (O2): a sampled range partitioning plus per-partition sorts.

    Give a total order (tie-breaking columns) when the output is compared or
    paged; the sort itself never funnels through one task.
    """
    return df.orderBy(*cols)


def preview(df: DataFrame, n: int = 20, order: Sequence[str | Column] = ()) -> DataFrame:
    """First ``n`` rows (L1), as ``show`` prints them.

    With ``order`` it is a top-n: Spark plans ``TakeOrderedAndProject``, each task
    keeps its own n best rows and only those n x tasks rows meet at the end.
    """
    if order:
        df = df.orderBy(*order)
    return df.limit(n)


def single_file(df: DataFrame) -> DataFrame:
    """One output partition (C2). Opt-in only: it serialises the last stage."""
    return df.coalesce(1)

