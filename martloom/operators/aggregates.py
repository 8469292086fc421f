"""Counts, maxima and the newest partition, each as a one-row DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _predicate(condition: str | Column) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def count_where(df: DataFrame, condition: str | Column = "1=1", alias: str = "rows") -> DataFrame:
    """Rows that satisfy the predicate."""
    return df.where(_predicate(condition)).agg(F.count("*").alias(alias))


def max_where(
    df: DataFrame, column: str, condition: str | Column = "1=1", alias: str = "max_value"
) -> DataFrame:
    """Largest value under the predicate; NULL when no row satisfies it."""
    return df.where(_predicate(condition)).agg(F.max(column).alias(alias))


def last_partition(partitions: DataFrame) -> DataFrame:
    """Newest partition by string order; no row for a table without any."""
    return partitions.orderBy(F.col("partition").desc()).limit(1)
