"""Retention: drop partitions that are past their lifetime."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.config import Lifetime
from martloom.functions import partition_value, retention_cutoff
from martloom.operators.ddl import recover_partitions
from martloom.operators.partitions import drop_partitions
from martloom.sources.files import partition_inventory
from martloom.sources.tables import list_partitions, table_facts


def retention_plan(
    partitions: DataFrame, touched: DataFrame, partition_column: str, run_start: str, lifetime: Lifetime
) -> DataFrame:
    """Every partition with its value, the cutoff, whether this run touched it,
    and whether it expires.

    The comparison is on text, and the cutoff carries a time of day that the
    value does not: a partition dated on the cutoff day itself expires.
    ``touched`` holds the partitions written in this run, as ``partitions`` does;
    with several levels, one that was written does not protect another.
    """
    cutoff = retention_cutoff(F.to_timestamp_ntz(F.lit(run_start)), lifetime)
    mark = touched.select(F.col("partition").alias("__written")).distinct().withColumn("touched", F.lit(True))
    return (
        partitions.select("partition", partition_value("partition", partition_column).alias("value"))
        .join(mark, F.col("partition") == F.col("__written"), "left")
        .select(
            "partition",
            "value",
            cutoff.alias("cutoff"),
            F.coalesce("touched", F.lit(False)).alias("touched"),
        )
        .withColumn("expired", ~F.col("touched") & (F.col("value") < F.col("cutoff")))
    )


def apply_retention(
    spark: SparkSession,
    table: str,
    partition_column: str,
    run_start: str,
    lifetime: Lifetime,
    recover: bool = True,
) -> int:
    """Drop expired partitions, files and catalog entries. Returns how many.

    Partitions modified after the run's start second are never candidates.
    Names decide first, so only the folders of partitions past the cutoff are
    listed, not the whole table. ``recover`` first visits every folder for
    partitions that others wrote past the catalog; a run that has just declared
    the table and written to it through the catalog needs none.
    """
    if recover:
        recover_partitions(spark, table)
    listed = list_partitions(spark, table)
    none_touched = listed.where("false")
    past = retention_plan(listed, none_touched, partition_column, run_start, lifetime).where("expired")
    names = [row["partition"] for row in past.select("partition").collect()]
    if not names:
        return 0
    facts = table_facts(spark, table)
    after = datetime.fromisoformat(run_start) + timedelta(seconds=1)
    touched = partition_inventory(
        spark, [f"{facts.location}/{name}" for name in names], facts.partition_columns, since=after.isoformat(sep=" ")
    )
    plan = retention_plan(listed, touched, partition_column, run_start, lifetime)
    return drop_partitions(spark, table, plan.where("expired"))
