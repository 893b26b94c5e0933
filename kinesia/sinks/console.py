"""Console sinks (K4, K5) for interactive runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def show_outputs(frames: Sequence[DataFrame], n: int = 20, truncate: bool = True) -> None:
    """Print the first rows of each output (K4); only ``n`` rows reach the driver."""
    for df in frames:
        df.show(n, truncate=truncate)


def console_stream_writer(df: DataFrame, output_mode: str = "append", num_rows: int = 20) -> DataStreamWriter:
    """Streaming console writer (K5): untruncated, ``num_rows`` per batch."""
    return (
        df.writeStream.format("console")
        .outputMode(output_mode)
        .option("truncate", False)
        .option("numRows", num_rows)
    )
