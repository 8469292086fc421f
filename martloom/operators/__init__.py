"""Joins, projections, aggregates, sinks and table definitions."""

from martloom.operators.aggregates import count_where, last_partition, max_where
from martloom.operators.ddl import declare_table, recover_partitions, recreate_table, redeclare_table
from martloom.operators.joins import HotKeys, left_join
from martloom.operators.partitions import drop_partitions, truncate_partitions
from martloom.operators.projections import filter_report_date, stamp_load
from martloom.operators.sinks import append_row, overwrite_partitions, overwrite_table

__all__ = [
    "HotKeys",
    "append_row",
    "count_where",
    "declare_table",
    "drop_partitions",
    "filter_report_date",
    "last_partition",
    "left_join",
    "max_where",
    "overwrite_partitions",
    "overwrite_table",
    "recover_partitions",
    "recreate_table",
    "redeclare_table",
    "stamp_load",
    "truncate_partitions",
]
