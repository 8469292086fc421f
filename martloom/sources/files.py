"""Parquet files under a table, as rows.

The listing comes from Spark's own file source, so many folders are listed by
the executors. Only names, lengths and times are read, never file contents.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.dates import RUN_START_FORMAT
from martloom.functions.partition_text import column_names


# Tasks of a listing for each core; a task may look at any number of files.
_TASKS_PER_CORE = 4


def _millis(spark: SparkSession, since: str) -> int:
    """A run timestamp of the session's zone as milliseconds."""
    time = spark.sparkContext._jvm.java.time
    there = time.LocalDateTime.parse(since, time.format.DateTimeFormatter.ofPattern(RUN_START_FORMAT))
    zone = time.ZoneId.of(spark.conf.get("spark.sql.session.timeZone"))
    return there.atZone(zone).toInstant().toEpochMilli()


def partition_inventory(
    spark: SparkSession,
    location: str | list[str],
    partition_columns: str | Sequence[str],
    since: str | None = None,
) -> DataFrame:
    """One row per Parquet file below ``location`` that belongs to a partition:
    ``partition``, the folders of all partition columns, and each value as its
    folder spells it; path, length, time.

    ``since``, a run timestamp in the session's zone, keeps files modified at
    or after that second; the others are dropped while listing and cost no task.

    Spark packs files into tasks by their length, of which nothing is read
    here; so the tasks are merged to a few for each core, without a shuffle.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
    )
    if since is not None:
        # The reader's bound is exclusive, ours is inclusive. It is stated in
        # UTC because only there the reader takes it without a shift.
        millis = _millis(spark, since) - 1
        bound = datetime.fromtimestamp(millis // 1000, UTC).strftime("%Y-%m-%dT%H:%M:%S")
        reader = reader.option("timeZone", "UTC").option("modifiedAfter", f"{bound}.{millis % 1000:03d}")
    columns = column_names(partition_columns)
    folders = "/".join(f"{re.escape(c)}=([^/]*)" for c in columns)
    pattern = f"/({folders})/[^/]*$"
    values = (F.regexp_extract("path", pattern, i).alias(c) for i, c in enumerate(("partition", *columns), 1))
    listed = reader.load(location).select(*values, "path", "length", "modificationTime")
    tasks = _TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return listed.where(F.col("partition") != "").coalesce(tasks)


def partition_sizes(inventory: DataFrame, partition_columns: str | Sequence[str]) -> DataFrame:
    """Files, bytes, largest and newest file per partition."""
    return inventory.groupBy("partition", *column_names(partition_columns)).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.max("length").alias("largest"),
        F.max("modificationTime").alias("modified"),
    )


def folder_times(spark: SparkSession, location: str, levels: int) -> dict[str, tuple[str, int]]:
    """``partition: (folder, time)`` of the partition folders ``levels`` below
    ``location``; a time is when a file was put there or taken away.

    Only folders are looked at, one file-system call for each parent; their
    files are not. A store without folder times says 0.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(location)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [("", root, 0)]
    for _ in range(levels):
        below = ((name, child) for name, folder, _ in found for child in system.listStatus(folder) if child.isDirectory())
        paths = ((name, child.getPath(), child.getModificationTime()) for name, child in below)
        found = [(f"{name}/{path.getName()}", path, time) for name, path, time in paths if "=" in path.getName()]
    return {name.lstrip("/"): (path.toString(), time) for name, path, time in found}


def changed_folders(spark: SparkSession, location: str, levels: int, since: str) -> list[str]:
    """Partition folders, ``levels`` below ``location``, with a time at or after
    ``since``. A store without folder times says they all changed."""
    bound = _millis(spark, since)
    return [path for path, time in folder_times(spark, location, levels).values() if not time or time >= bound]


def touched_partitions(
    spark: SparkSession, location: str, partition_columns: str | Sequence[str], run_start: str
) -> DataFrame:
    """``partition`` and values of the partitions with a file from the run's
    start second or later. Only folders that changed since are listed."""
    columns = column_names(partition_columns)
    folders = changed_folders(spark, location, len(columns), run_start)
    listed = partition_inventory(spark, folders or location, columns, since=run_start)
    return listed.where(F.lit(bool(folders))).select("partition", *columns).distinct()
