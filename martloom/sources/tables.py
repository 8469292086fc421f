"""Catalog tables: rows, partitions, location."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def scan_partition(spark: SparkSession, table: str, partition_column: str, value: str) -> DataFrame:
    """One partition without its partition column. The filter prunes the scan
    to that partition's files."""
    return spark.table(table).where(F.col(partition_column) == value).drop(partition_column)


def scan_partition_path(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One partition folder, read by path. ``schema`` has no partition column;
    stating it avoids a pass over the file footers."""
    return spark.read.schema(schema).parquet(path)


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    """One row per partition in the catalog: ``partition``, in no set order."""
    return spark.sql("SHOW PARTITIONS IDENTIFIER(:t)", args={"t": table})


@dataclass(frozen=True)
class TableFacts:
    """What the catalog says about a table."""

    location: str
    external: bool
    partition_columns: tuple[str, ...]
    overwrite_mode: str | None


def table_facts(spark: SparkSession, table: str) -> TableFacts:
    described = spark.sql("DESCRIBE TABLE FORMATTED IDENTIFIER(:t)", args={"t": table}).collect()
    names = [row["col_name"] for row in described]
    details = {
        row["col_name"]: row["data_type"]
        for row in described[names.index("# Detailed Table Information") :]
    }
    keys: list[str] = []
    if "# Partition Information" in names:
        start = names.index("# Partition Information") + 2
        keys = names[start : names.index("", start)]
    properties = details.get("Storage Properties", "").strip("[]").split(", ")
    stored = dict(item.split("=", 1) for item in properties if "=" in item)
    return TableFacts(
        location=details["Location"],
        external=details["Type"] == "EXTERNAL",
        partition_columns=tuple(keys),
        overwrite_mode=stored.get("partitionOverwriteMode"),
    )


def table_location(spark: SparkSession, table: str) -> str:
    return table_facts(spark, table).location


def is_external(spark: SparkSession, table: str) -> bool:
    return table_facts(spark, table).external


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return list(table_facts(spark, table).partition_columns)
