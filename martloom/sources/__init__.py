"""Reading tables, partitions and the files under them."""

from martloom.sources.files import changed_folders, folder_times, partition_inventory, partition_sizes, touched_partitions
from martloom.sources.tables import (
    is_external,
    list_partitions,
    partition_columns,
    scan_partition,
    scan_partition_path,
    scan_table,
    table_facts,
    table_location,
)

__all__ = [
    "changed_folders",
    "folder_times",
    "is_external",
    "list_partitions",
    "partition_columns",
    "partition_inventory",
    "partition_sizes",
    "scan_partition",
    "scan_partition_path",
    "scan_table",
    "table_facts",
    "table_location",
    "touched_partitions",
]
