"""Writes into declared tables."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martloom.config import BLOCK_BYTES
from martloom.functions import narrow_to
from martloom.sources.literals import literal_rows
from martloom.sources.tables import table_facts

# A row takes about so many times the bytes in a shuffle that it takes in a file.
SHUFFLED_PER_STORED = 1.2
# Folders of an unpartitioned table's versions, hidden from listings of it.
VERSION = "_version-"

_ADVISORY = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": None,
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
}
_PLAIN_VALUE = re.compile(r"[A-Za-z0-9_.-]+")
_lock = threading.Lock()
_writing: dict = {"depth": 0, "before": {}}


@contextmanager
def _files_of(spark: SparkSession, file_bytes: int) -> Iterator[None]:
    """Adaptive execution aims at tasks that write files of ``file_bytes``.
    The setting is the session's: writes at the same time share it, and the
    last one puts back what was there."""
    wanted = {**_ADVISORY, "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(file_bytes * SHUFFLED_PER_STORED))}
    with _lock:
        if not _writing["depth"]:
            _writing["before"] = {key: spark.conf.get(key, None) for key in wanted}
        _writing["depth"] += 1
        for key, value in wanted.items():
            spark.conf.set(key, value)
    try:
        yield
    finally:
        with _lock:
            _writing["depth"] -= 1
            if not _writing["depth"]:
                for key, value in _writing["before"].items():
                    spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def overwrite_partitions(
    df: DataFrame, table: str, on_overflow: str = "raise", rebalance: bool | str = True, block_bytes: int = BLOCK_BYTES
) -> dict[str, int] | None:
    """Replace exactly the partitions present in ``df``; an empty ``df``
    changes nothing. Columns are matched by name and narrowed to the table's
    types.

    ``rebalance`` shuffles rows by partition before the write, for results of
    many dates: adaptive execution splits a large partition and merges small
    ones, so neither one date in a single task nor one small file per task and
    date can result. ``"blocks"`` suits a result of one date: rows are dealt
    out without regard to their values, to tasks that write about a block each,
    so that the date is written once and needs no compaction. A session
    without adaptive execution, where nothing would split a large partition,
    is refused.

    Returns ``{partition: rows}`` if all rows went to one partition, as counted
    by the tasks that wrote them; else None.
    """
    spark = df.sparkSession
    facts = table_facts(spark, table)
    if not facts.partition_columns:
        raise ValueError(f"{table} is not partitioned")
    mode = facts.overwrite_mode or spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    if mode.lower() != "dynamic":
        # Static mode would wipe every other partition.
        raise ValueError(f"{table} is not in dynamic partition overwrite mode")
    rows = narrow_to(df, spark.table(table).schema, on_overflow)
    if rebalance and spark.conf.get("spark.sql.adaptive.enabled") != "true":
        raise ValueError("rebalancing partitions needs spark.sql.adaptive.enabled")
    if rebalance == "blocks":
        rows = rows.hint("rebalance")
    elif rebalance:
        rows = rows.hint("rebalance", *facts.partition_columns)
    # Counted behind the shuffle, where a task counts once however often it is tried.
    seen, keys = Observation(), facts.partition_columns
    ends = [f(F.col(f"`{key}`").cast("string")).alias(f"{name}{i}") for i, key in enumerate(keys) for name, f in (("low", F.min), ("high", F.max))]
    filled = [F.count(F.col(f"`{key}`")).alias(f"n{i}") for i, key in enumerate(keys)]
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), *filled, *ends)
    if rebalance == "blocks":
        with _files_of(spark, block_bytes):
            counted.write.insertInto(table, overwrite=True)
    else:
        counted.write.insertInto(table, overwrite=True)
    found = seen.get
    values = [(found.get(f"low{i}"), found.get(f"high{i}")) for i in range(len(keys))]
    # Folders spell odd characters differently; a NULL is at neither end.
    plain = all(low is not None and low == high and _PLAIN_VALUE.fullmatch(low) for low, high in values)
    if not plain or any(found[f"n{i}"] != found["n_rows"] for i in range(len(keys))):
        return None
    return {"/".join(f"{key}={low}" for key, (low, _) in zip(keys, values, strict=True)): found["n_rows"]}


def file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def base_folder(location: str) -> str:
    """Where a table was declared: its location without a version's folder."""
    location = location.rstrip("/")
    parent, _, name = location.rpartition("/")
    return parent if name.startswith(VERSION) else location


def current_folder(spark: SparkSession, location: str) -> str:
    """The newest finished version below ``location``, else ``location``."""
    system, path = file_system(spark, location)
    found = []
    for child in system.listStatus(path) if system.exists(path) else ():
        if child.isDirectory() and child.getPath().getName().startswith(VERSION):
            done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(child.getPath(), "_SUCCESS")
            if system.exists(done):
                found.append((child.getModificationTime(), child.getPath().toString()))
    return max(found)[1] if found else location


def table_files(spark: SparkSession, folder: str) -> dict[str, int]:
    """Parquet files right below ``folder``, and their lengths."""
    system, path = file_system(spark, folder)
    listed = system.listStatus(path) if system.exists(path) else ()
    files = (f for f in listed if f.isFile() and f.getPath().getName().endswith(".parquet"))
    return {f.getPath().toString(): f.getLen() for f in files if not f.getPath().getName().startswith(("_", "."))}


def _delete(spark: SparkSession, paths: Sequence[str]) -> None:
    for name in paths:
        system, path = file_system(spark, name)
        system.delete(path, True)


def new_version(rows: DataFrame, location: str) -> str:
    """``rows`` in a version's folder below ``location``; nothing is left of it
    if that fails."""
    folder = f"{base_folder(location)}/{VERSION}{uuid.uuid4().hex}"
    try:
        rows.write.parquet(folder)
    except BaseException:
        _delete(rows.sparkSession, [folder])
        raise
    return folder


def drop_version(spark: SparkSession, location: str, files: Sequence[str]) -> None:
    """Remove what a table had at ``location`` before another version."""
    if base_folder(location) != location.rstrip("/"):
        _delete(spark, [location])
    else:
        _delete(spark, files)


def overwrite_table(df: DataFrame, table: str, on_overflow: str = "raise", replaced: Sequence[str] | None = None) -> None:
    """Replace all rows of an unpartitioned table; an empty ``df`` empties it.
    Columns are matched by name and narrowed to the table's types.

    The rows are written once, to a folder of their own below the table's; then
    the catalog's location of the table is set to it, which is one change, and
    the old files go. Until then the table is what it was, so a failure changes
    nothing and ``df`` may read the table itself.

    ``replaced`` names the files that ``df`` stands for: rows that others
    appended in other files meanwhile are taken along. Without it, they go.
    """
    spark = df.sparkSession
    facts = table_facts(spark, table)
    if facts.partition_columns:
        raise ValueError(f"{table} is partitioned")
    schema = spark.table(table).schema
    folder = new_version(narrow_to(df, schema, on_overflow), facts.location)
    spark.sql("ALTER TABLE IDENTIFIER(:t) SET LOCATION :folder", args={"t": table, "folder": folder})
    spark.catalog.refreshTable(table)
    before = list(table_files(spark, facts.location))
    late = [] if replaced is None else sorted(set(before) - set(replaced))
    if late:
        spark.read.schema(schema).parquet(*late).write.insertInto(table, overwrite=False)
    drop_version(spark, facts.location, before)


def append_row(spark: SparkSession, table: str, **values) -> None:
    """Append one row. Columns without a value become NULL; a name that is not
    a column is an error."""
    schema = spark.table(table).schema
    unknown = sorted(set(values) - set(schema.fieldNames()))
    if unknown:
        raise ValueError(f"{table} has no columns {unknown}")
    row = tuple(values.get(name) for name in schema.fieldNames())
    literal_rows(spark, [row], schema).write.insertInto(table, overwrite=False)
