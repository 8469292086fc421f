"""Table definitions."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import narrow_to
from martloom.functions.partition_text import column_names
from martloom.operators.sinks import base_folder, current_folder, drop_version, file_system, new_version, table_files
from martloom.sources.files import folder_times
from martloom.sources.footers import file_schema
from martloom.sources.literals import literal_rows
from martloom.sources.tables import is_external, table_facts

_FOLDERS_PER_JOB = 200


def declare_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_columns: str | Sequence[str] | None = None,
    location: str | None = None,
    make_folder: bool = True,
) -> None:
    """Declare a Parquet table unless it exists: external when a location is
    given, else managed. Column comments come from the schema's metadata. A
    partitioned table is put in dynamic overwrite mode for good."""
    known = spark.catalog.tableExists(table)
    ddl = f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:t) ({schema.toDDL()}) USING parquet"
    args = {"t": table}
    if partition_columns:
        keys = ", ".join(f"`{name}`" for name in column_names(partition_columns))
        ddl += f" OPTIONS (partitionOverwriteMode = 'dynamic') PARTITIONED BY ({keys})"
    if location:
        ddl += " LOCATION :location"
        args["location"] = location
    spark.sql(ddl, args=args)
    if location and not known and make_folder:
        # An external folder may not exist yet; an empty append makes it, so
        # that listings of a table without rows find an empty folder.
        literal_rows(spark, [], spark.table(table).schema).write.insertInto(table)


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Bring the catalog in line with the folders: add new partitions, drop
    those whose folder is gone."""
    spark.sql("MSCK REPAIR TABLE IDENTIFIER(:t) SYNC PARTITIONS", args={"t": table})


def recreate_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    location: str,
    partition_columns: str | Sequence[str] | None = None,
) -> None:
    """Drop and re-declare an external table so that a changed definition
    applies. Files stay, and partitions are found again.

    Files whose columns have other types than the definition are written anew
    first, partition by partition: read by their own types and narrowed, so a
    value that does not fit fails the call before the definition has changed,
    and calling it again goes on where it stopped.
    """
    known, keys = spark.catalog.tableExists(table), column_names(partition_columns)
    if known and not is_external(spark, table):
        raise ValueError(f"{table} is managed: dropping it would delete its files")
    folder, old = location, ()
    if keys:
        _refit_partitions(spark, location, schema, keys)
    else:
        folder = current_folder(spark, location)
        folder, old = _refit_table(spark, folder, schema)
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": table})
    declare_table(spark, table, schema, partition_columns, folder, make_folder=not known)
    if old:
        drop_version(spark, *old)
    if keys:
        recover_partitions(spark, table)


def _misfit(found: T.StructType, schema: T.StructType) -> bool:
    """Whether a column is stored in another type than it is declared in."""
    types = {f.name.lower(): f.dataType for f in found}
    return any(types.get(f.name.lower(), f.dataType) != f.dataType for f in schema)


def _refitted(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` in the columns and types of ``schema``; new columns are NULL."""
    given = {name.lower(): name for name in rows.columns}
    columns = [
        F.col(f"`{given[f.name.lower()]}`").alias(f.name) if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return narrow_to(rows.select(*columns), schema)


def _refit_partitions(spark: SparkSession, location: str, schema: T.StructType, keys: tuple[str, ...]) -> None:
    """Write anew the partitions below ``location`` whose files no longer fit.

    One footer speaks for a partition, whose files are always written together;
    the driver reads them, some at a time. Partitions stored alike go through
    one job, no shuffle, for up to ``_FOLDERS_PER_JOB`` of them.
    """
    system, path = file_system(spark, location)
    if not system.exists(path):
        return

    def stored(folder: str) -> T.StructType | None:
        files = table_files(spark, folder)
        return file_schema(spark, min(files)) if files else None

    folders = [folder for folder, _ in folder_times(spark, location, len(keys)).values()]
    with ThreadPoolExecutor(16) as pool:
        asked = [pool.submit(inheritable_thread_target(spark)(stored), folder) for folder in folders]
        found = [a.result() for a in asked]
    data = T.StructType([f for f in schema if f.name not in keys])
    groups: dict[str, list[str]] = {}
    for folder, own in zip(folders, found, strict=True):
        if own is not None and _misfit(own, data):
            groups.setdefault(own.json(), []).append(folder)
    for own, alike in groups.items():
        fields = [f for f in T.StructType.fromJson(json.loads(own)) if f.name not in keys]
        read = T.StructType([*fields, *(schema[key] for key in keys)])
        for start in range(0, len(alike), _FOLDERS_PER_JOB):
            part = alike[start : start + _FOLDERS_PER_JOB]
            rows = _refitted(spark.read.schema(read).option("basePath", location).parquet(*part), schema)
            write = rows.write.mode("overwrite").partitionBy(*keys)
            write.option("partitionOverwriteMode", "dynamic").parquet(location)


def _refit_table(spark: SparkSession, folder: str, schema: T.StructType) -> tuple[str, tuple]:
    """An unpartitioned table's folder, a new version of it if a file no longer
    fits; then also what to drop once the new one is declared."""
    files = table_files(spark, folder)
    kinds: dict[str, list[str]] = {}
    for file in files:
        kinds.setdefault(file_schema(spark, file).json(), []).append(file)
    if not any(_misfit(T.StructType.fromJson(json.loads(own)), schema) for own in kinds):
        return folder, ()
    parts = [_refitted(spark.read.schema(T.StructType.fromJson(json.loads(own))).parquet(*names), schema) for own, names in kinds.items()]
    return new_version(reduce(DataFrame.unionAll, parts), folder), (folder, list(files))


def _is_declared(
    spark: SparkSession, table: str, schema: T.StructType, location: str, keys: tuple[str, ...]
) -> bool:
    """Whether the catalog holds exactly this definition of an external table."""
    if not spark.catalog.tableExists(table):
        return False
    facts = table_facts(spark, table)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # The catalog keeps partition columns last.
    ordered = [f for f in schema if f.name not in keys] + [schema[name] for name in keys]

    def facts_of(fields):
        return [(f.name, f.dataType.simpleString(), f.metadata.get("comment")) for f in fields]

    return (
        facts.external
        and facts.partition_columns == keys
        and base_folder(facts.location) == system.makeQualified(path).toString().rstrip("/")
        and facts_of(spark.table(table).schema) == facts_of(ordered)
    )


def redeclare_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    location: str,
    partition_columns: str | Sequence[str] | None = None,
) -> bool:
    """``recreate_table`` if the definition differs from the declared one, so
    that partitions are searched for only then. Returns whether it did."""
    keys = column_names(partition_columns)
    if _is_declared(spark, table, schema, location, keys):
        return False
    recreate_table(spark, table, schema, location, keys)
    return True
