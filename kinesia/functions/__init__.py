"""Column expressions: everything here returns a native ``Column`` (no UDFs)."""

from kinesia.functions.keys import composite_key, joined_values
from kinesia.functions.magnitude import magnitude, magnitude_of_doubles
from kinesia.functions.missing import all_missing, missing_cell, sentinel_to_null, to_decimal, to_int
from kinesia.functions.time import bucket_index, bucket_width, time_tick

__all__ = [
    "all_missing",
    "bucket_index",
    "bucket_width",
    "composite_key",
    "joined_values",
    "magnitude",
    "magnitude_of_doubles",
    "missing_cell",
    "sentinel_to_null",
    "time_tick",
    "to_decimal",
    "to_int",
]
