"""File sinks (K1, K6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_outputs(
    frames: Sequence[DataFrame],
    paths: Sequence[str],
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    **options,
) -> None:
    """Write output *i* to path *i* (K1).

    The reference zipped outputs with paths and silently dropped extras; a
    count mismatch raises here. Each write is one distributed job; files are
    committed by Spark's output committer, so a lost task is simply re-run.
    """
    if len(frames) != len(paths):
        raise ValueError(f"{len(frames)} outputs but {len(paths)} paths")
    for df, path in zip(frames, paths):
        df.write.format(fmt).mode(mode).options(**options).save(path)


def write_single_file(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write as one file (K6). Opt-in: the last stage runs as one task."""
    df.coalesce(1).write.format(fmt).mode(mode).save(path)


def write_csv(df: DataFrame, path: str, *, header: bool = True, mode: str = "overwrite") -> None:
    """CSV in the raw input's format: ``,`` delimiter, optional header row."""
    df.write.mode(mode).option("header", header).csv(path)
