"""Parquet sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kinesia.schema import FEATURES, LABEL


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Plain Parquet scan (S4); later selects and filters reach the reader."""
    return spark.read.parquet(path)


def read_features(
    spark: SparkSession,
    path: str,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
) -> DataFrame:
    """Parquet scan projected to the features and the label (S3).

    The projection sits right on the scan, so ``ReadSchema`` holds only these
    columns.
    """
    return spark.read.parquet(path).select(*features, label)


def read_parquet_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    *,
    file_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files landing in ``directory`` as a stream (S2's Parquet twin).

    A streaming source reads directories only; ``file_glob`` picks the files
    of one table when several share a folder.
    """
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(directory)
