"""Filters and literal columns of the mart query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_report_date(df: DataFrame, date: str, partition_column: str = "report_dt") -> DataFrame:
    """Rows of one report date; a partition filter when the source is
    partitioned by it."""
    return df.where(F.col(partition_column) == date)


def stamp_load(
    df: DataFrame,
    load_id: int,
    run_start: str,
    load_id_column: str = "ctl_loading",
    run_start_column: str = "ctl_validfrom",
) -> DataFrame:
    """Put the load id and the run start in front of every row."""
    return df.select(
        F.lit(load_id).cast("int").alias(load_id_column),
        F.lit(run_start).alias(run_start_column),
        "*",
    )
