"""Writers: Parquet/CSV files, single-file output, Kafka payloads, console, models."""

from kinesia.sinks.console import console_stream_writer, show_outputs
from kinesia.sinks.files import write_csv, write_outputs, write_single_file
from kinesia.sinks.kafka import kafka_payload, kafka_stream_writer, write_kafka
from kinesia.sinks.models import save_model

__all__ = [
    "console_stream_writer",
    "kafka_payload",
    "kafka_stream_writer",
    "save_model",
    "show_outputs",
    "write_csv",
    "write_kafka",
    "write_outputs",
    "write_single_file",
]
