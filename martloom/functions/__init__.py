"""Column expressions. All of them stay inside Spark's own functions."""

from martloom.functions.change import change_flag
from martloom.functions.dates import retention_cutoff, run_start_text, run_start_timestamp
from martloom.functions.narrowing import narrow, narrow_to
from martloom.functions.partition_text import (
    date_suffix,
    in_date_suffix_range,
    partition_value,
    report_date,
)
from martloom.functions.sizing import target_file_count

__all__ = [
    "change_flag",
    "date_suffix",
    "in_date_suffix_range",
    "narrow",
    "narrow_to",
    "partition_value",
    "report_date",
    "retention_cutoff",
    "run_start_text",
    "run_start_timestamp",
    "target_file_count",
]
