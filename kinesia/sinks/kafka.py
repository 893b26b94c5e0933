"""Kafka sinks (K2, K3).

The connector is not on the classpath here and no broker exists, so only the
payload is tested; the writers are thin and set what the reference left out
(a topic and a ``value`` column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def kafka_payload(df: DataFrame, key_col: str | None = "user_id") -> DataFrame:
    """``key`` (text, optional) and ``value`` = the whole row as JSON text."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")
    if key_col is None:
        return df.select(value)
    return df.select(F.col(key_col).cast("string").alias("key"), value)


def write_kafka(
    df: DataFrame, servers: str, topic: str, *, key_col: str | None = "user_id", compression: str = "gzip"
) -> None:
    """Batch write of the payload to a topic (K2)."""
    (
        kafka_payload(df, key_col)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.compression.type", compression)
        .option("topic", topic)
        .save()
    )


def kafka_stream_writer(
    df: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    *,
    key_col: str | None = "user_id",
    output_mode: str = "append",
    compression: str = "gzip",
) -> DataStreamWriter:
    """Streaming writer of the payload (K3); one checkpoint folder per output."""
    return (
        kafka_payload(df, key_col)
        .writeStream.format("kafka")
        .outputMode(output_mode)
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.compression.type", compression)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
