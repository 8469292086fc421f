"""Compaction: as many files per partition as its bytes ask for.

Files that are only too many are merged as they are: each task reads some of
them and writes one, without a shuffle, and rows keep their order within a
file. Only partitions with a file well above a block are shuffled, to split it.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.config import BLOCK_BYTES
from martloom.functions import target_file_count
from martloom.operators.partitions import stored_value
from martloom.operators.sinks import overwrite_partitions, overwrite_table, table_files
from martloom.sources.files import partition_inventory, partition_sizes, touched_partitions
from martloom.sources.literals import literal_rows
from martloom.sources.tables import table_facts


# Output files of one write job: what a shuffle holds about its tasks stays
# small however much there is to compact.
FILES_PER_JOB = 10_000
# A file above so many blocks is split; merging would only make it larger.
SPLIT_ABOVE = 1.5
# Partitions merged at the same time, each by a job of its own.
MERGES_AT_ONCE = 8
# Files an unpartitioned table may have before they are merged.
LOOSE_FILES = 32


def compaction_plan(sizes: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``sizes`` (files and bytes per partition) with ``target_files``. Empty
    partitions need no work and are left out."""
    return sizes.where(F.col("bytes") > 0).withColumn("target_files", target_file_count("bytes", block_bytes))


def compact_partitions(
    spark: SparkSession,
    table: str,
    run_start: str | None = None,
    block_bytes: int = BLOCK_BYTES,
    files_per_job: int = FILES_PER_JOB,
    slack: float = 1.0,
) -> list[dict]:
    """Rewrite partitions to their target file count; with ``run_start`` only
    those written since, and only their folders are listed. Returns what was
    rewritten, and whether by a merge.

    A partition is a folder of files: with several partition columns, one value
    of each. Partitions with the right number of files are not rewritten; with
    ``slack``, nor are those with up to so many times as many and none to split.

    Partitions to split go through one shuffle for about ``files_per_job``
    output files, and all of one partition through the same: every output file
    has its own task, and a partition's rows are dealt out to its files at
    random. The overwrite is staged, and replaces a partition only when all of
    its new files are there.
    """
    facts = table_facts(spark, table)
    keys, folders = facts.partition_columns, facts.location
    if run_start is not None:
        touched = touched_partitions(spark, facts.location, keys, run_start)
        folders = [f"{facts.location}/{row['partition']}" for row in touched.collect()]
        if not folders:
            return []
    sizes = partition_sizes(partition_inventory(spark, folders, keys), keys)
    files, target = F.col("files"), F.col("target_files")
    whole = F.col("largest") <= SPLIT_ABOVE * block_bytes
    settled = (files == target) if slack == 1 else (files <= slack * target) & whole
    due = compaction_plan(sizes, block_bytes).where(~settled).withColumn("merge", whole & (files >= target))
    plan = sorted((row.asDict() for row in due.collect()), key=lambda row: row["partition"])
    with ThreadPoolExecutor(MERGES_AT_ONCE) as pool:
        # A wrapper for each: its properties are the thread's own.
        tasks = {
            row["partition"]: pool.submit(inheritable_thread_target(spark)(_merge), spark, table, keys, row)
            for row in plan
            if row["merge"]
        }
    for row in plan:
        row["merge"] = row["merge"] and tasks[row["partition"]].result()
    for batch in _batches([row for row in plan if not row["merge"]], files_per_job):
        _rewrite(spark, table, keys, batch)
    return plan


def _merge(spark: SparkSession, table: str, keys: tuple[str, ...], row: dict) -> bool:
    """Put the files of one partition together. False if its scan has fewer
    tasks than files are wanted, as where a session reads large ones."""
    rows = spark.table(table)
    for key in keys:
        value = stored_value(row[key])
        # A stated value: the write need not sort rows by partition.
        rows = rows.where(F.col(key).isNull() if value is None else F.col(key) == value)
        rows = rows.withColumn(key, F.lit(value).cast(rows.schema[key].dataType))
    target = row["target_files"]
    if target > 1 and rows.rdd.getNumPartitions() < target:
        return False
    overwrite_partitions(rows.coalesce(target), table, rebalance=False)
    return True


def compact_table(spark: SparkSession, table: str, block_bytes: int = BLOCK_BYTES, loose_files: int = LOOSE_FILES) -> int:
    """Merge the files of an unpartitioned table once there are more than
    ``loose_files`` and than its bytes ask for. Returns how many there were, 0
    if it was left alone. Readers see the old files or the new ones; rows that
    are appended meanwhile are kept."""
    files = table_files(spark, table_facts(spark, table).location)
    target = sum(files.values()) // block_bytes + 1
    if len(files) <= max(loose_files, target):
        return 0
    rows = spark.read.schema(spark.table(table).schema).parquet(*files)
    overwrite_table(rows.coalesce(target), table, replaced=list(files))
    return len(files)


def _batches(plan: list[dict], files_per_job: int) -> Iterator[list[dict]]:
    batch, files = [], 0
    for row in plan:
        if batch and files + row["target_files"] > files_per_job:
            yield batch
            batch, files = [], 0
        batch.append(row)
        files += row["target_files"]
    if batch:
        yield batch


def _rewrite(spark: SparkSession, table: str, keys: tuple[str, ...], batch: list[dict]) -> None:
    """Rewrite the partitions of ``batch`` in one job."""
    specs = [tuple(stored_value(row[key]) for key in keys) for row in batch]
    counts = [row["target_files"] for row in batch]
    firsts = [0, *accumulate(counts)]
    named = [f"__{i}" for i in range(len(keys))]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in named])
    schema = schema.add("__first", T.LongType()).add("__files", T.LongType())
    slots = literal_rows(spark, [(*s, f, n) for s, f, n in zip(specs, firsts, counts, strict=False)], schema)

    rows = spark.table(table)
    for i, key in enumerate(keys):
        # For the catalog, which prunes by plain comparisons of one column.
        values = {spec[i] for spec in specs}
        wanted = F.col(key).isin(sorted(values - {None}))
        rows = rows.where(wanted | F.col(key).isNull() if None in values else wanted)
    if len(keys) > 1:
        whole = F.concat_ws("/", *(F.col(key).cast("string") for key in keys))
        rows = rows.where(whole.isin(["/".join(v for v in spec if v is not None) for spec in specs]))
    same = [F.col(key).cast("string").eqNullSafe(F.col(name)) for key, name in zip(keys, named, strict=True)]
    # One row per partition being rewritten.
    dealt = rows.join(slots, reduce(and_, same))
    file_id = F.col("__first") + F.floor(F.rand(seed=11) * F.col("__files"))
    exact = dealt.repartitionById(firsts[-1], file_id.cast("int")).drop(*schema.fieldNames())
    overwrite_partitions(exact, table, rebalance=False)
