"""Removing partitions."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import in_date_suffix_range
from martloom.sources.literals import literal_rows
from martloom.sources.tables import is_external, list_partitions, partition_columns, table_location

# Fixed value: the folder name of the NULL partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

_SPECS_PER_STATEMENT = 200


def stored_value(text: str) -> str | None:
    """A partition value as data, from the way its folder spells it."""
    return None if text == NULL_PARTITION else unquote(text)


def _spec(partition: str, args: dict) -> str:
    """``PARTITION (...)`` for one partition string, values as parameters."""
    parts = []
    for part in partition.split("/"):
        name, text = part.split("=", 1)
        value = stored_value(text)
        if value is None:
            parts.append(f"`{unquote(name)}` = null")
        else:
            marker = f"v{len(args)}"
            args[marker] = value
            parts.append(f"`{unquote(name)}` = :{marker}")
    return f"PARTITION ({', '.join(parts)})"


def _delete_folders(spark: SparkSession, table: str, partitions: list[str]) -> None:
    """Delete the folders of partitions below the table's location: one call to
    the file system each, and no Spark job."""
    location, hadoop = table_location(spark, table), spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(location)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for partition in partitions:
        folder = hadoop.Path(f"{location.rstrip('/')}/{partition}")
        if system.exists(folder) and not system.delete(folder, True):
            raise RuntimeError(f"could not delete {folder.toString()}")


def drop_partitions(spark: SparkSession, table: str, partitions: DataFrame) -> int:
    """Drop the listed partitions, a subset of ``list_partitions``, with their
    files. Returns how many.

    Only partition names reach the driver. The catalog deletes the files of a
    managed table; those of an external one are removed first, so that a
    failure in between leaves an empty partition and never orphaned rows. No
    Spark job runs for a partition.
    """
    names = [row["partition"] for row in partitions.select("partition").collect()]
    if is_external(spark, table):
        _delete_folders(spark, table, names)
    return _drop_from_catalog(spark, table, names)


def _drop_from_catalog(spark: SparkSession, table: str, names: list[str]) -> int:
    for start in range(0, len(names), _SPECS_PER_STATEMENT):
        args = {"t": table}
        specs = ", ".join(_spec(name, args) for name in names[start : start + _SPECS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) DROP IF EXISTS {specs}", args=args)
    return len(names)


def _empty_table(spark: SparkSession, table: str) -> None:
    """Delete the files of all partitions of an external table at once."""
    schema, keys = spark.table(table).schema, partition_columns(spark, table)
    nothing = literal_rows(spark, [], schema).write.mode("overwrite").partitionBy(*keys)
    nothing.option("partitionOverwriteMode", "static").parquet(table_location(spark, table))


def truncate_partitions(spark: SparkSession, table: str, from_date: str = "", to_date: str = "") -> int:
    """Drop the partitions whose date suffix lies in ``[from_date, to_date]``;
    without bounds, all of them."""
    listed = list_partitions(spark, table)
    if not from_date and not to_date:
        if is_external(spark, table):
            _empty_table(spark, table)
        return _drop_from_catalog(spark, table, [row["partition"] for row in listed.collect()])
    return drop_partitions(
        spark, table, listed.where(in_date_suffix_range(F.col("partition"), from_date, to_date))
    )
