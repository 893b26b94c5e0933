"""Readers: CSV batch and stream, Parquet, saved models, the derived IMU view."""

from kinesia.sources.csv import read_csv, read_csv_stream
from kinesia.sources.imu_view import imu_from_events
from kinesia.sources.parquet import read_features, read_parquet, read_parquet_stream

__all__ = [
    "imu_from_events",
    "read_csv",
    "read_csv_stream",
    "read_features",
    "read_parquet",
    "read_parquet_stream",
]
