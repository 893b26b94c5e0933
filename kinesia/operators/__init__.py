"""Table operators: ``DataFrame -> DataFrame`` steps of the jobs."""

from kinesia.operators.aggregate import bucketed_mean, distinct_values, multi_agg, row_count
from kinesia.operators.fill import forward_fill
from kinesia.operators.filters import drop_empty_rows, drop_incomplete, drop_key, keep_key
from kinesia.operators.projections import (
    drop_columns,
    measurement_columns,
    select_ordered,
    with_columns,
    with_magnitudes,
)
from kinesia.operators.setops import preview, single_file, sort_by, union_all
from kinesia.operators.signature import drop_outliers, flag_outliers, group_likeness, signature_cosine, signatures

__all__ = [
    "bucketed_mean",
    "distinct_values",
    "drop_columns",
    "drop_empty_rows",
    "drop_incomplete",
    "drop_key",
    "drop_outliers",
    "flag_outliers",
    "forward_fill",
    "group_likeness",
    "keep_key",
    "measurement_columns",
    "multi_agg",
    "preview",
    "row_count",
    "select_ordered",
    "signature_cosine",
    "signatures",
    "single_file",
    "sort_by",
    "union_all",
    "with_columns",
    "with_magnitudes",
]
