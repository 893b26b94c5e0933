"""CSV sources: batch with header (S1), streaming directory without header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kinesia.schema import raw_csv_schema, stream_csv_schema


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    header: bool = True,
    delimiter: str = ",",
) -> DataFrame:
    """Batch CSV scan with an explicit schema.

    No inference pass; the file splits into ``spark.sql.files.maxPartitionBytes``
    sized tasks and only the columns the plan uses are parsed.
    """
    return (
        spark.read.schema(schema or raw_csv_schema())
        .option("header", header)
        .option("delimiter", delimiter)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_csv_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType | None = None,
    *,
    max_files_per_trigger: int | None = None,
    header: bool = False,
    delimiter: str = ",",
) -> DataFrame:
    """Streaming CSV over a landing directory (S2); files per micro-batch as the caller says.

    Typed columns parse the ``NA`` sentinel to NULL (permissive mode).
    """
    reader = (
        spark.readStream.schema(schema or stream_csv_schema())
        .option("header", header)
        .option("delimiter", delimiter)
        .option("mode", "PERMISSIVE")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.csv(directory)
