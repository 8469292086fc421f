"""Run audit, change detection and run statistics."""

from __future__ import annotations

import time
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom import session
from martloom.functions import change_flag
from martloom.functions.partition_text import DATE_LENGTH
from martloom.operators.aggregates import count_where
from martloom.operators.partitions import stored_value
from martloom.operators.sinks import append_row, overwrite_table
from martloom.sources.files import folder_times
from martloom.sources.literals import literal_rows
from martloom.sources.tables import list_partitions, table_facts

# Names, types and order of the audit table's columns.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("ctl_loading", T.IntegerType()),
        T.StructField("ctl_validfrom", T.StringType()),
        T.StructField("partitions", T.StringType()),
        T.StructField("is_force_load", T.IntegerType()),
        T.StructField("last_success_step", T.IntegerType()),
        T.StructField("last_step_in_general", T.IntegerType()),
        T.StructField("count_rows", T.LongType()),
        T.StructField("is_change", T.IntegerType()),
    ]
)

# Rows by partition, as last counted: the folder's time then, and the time of
# counting, in milliseconds.
COUNTS_SCHEMA = T.StructType(
    [
        T.StructField("partition", T.StringType()),
        T.StructField("modified", T.LongType()),
        T.StructField("counted", T.LongType()),
        T.StructField("n_rows", T.LongType()),
    ]
)
# A folder time this close to the count may hide a later change: stores keep
# times to the second.
_SETTLED_MS = 2_000

# What a statistic id stands for.
STAT_TODAY = 1
STAT_CHANGE = 2
STAT_NEWEST_DATE = 5
STAT_RUN_START = 11
STAT_APPLICATION = 15

RUN_STATS_SCHEMA = T.StructType(
    [
        T.StructField("loading_id", T.IntegerType()),
        T.StructField("entity_id", T.IntegerType()),
        T.StructField("stat_id", T.IntegerType()),
        T.StructField("value", T.StringType()),
    ]
)


def last_step(audit: DataFrame) -> DataFrame:
    """One row, ``last_step``: the highest successful step of the latest run;
    0 when no run is recorded."""
    latest = F.max(F.struct("ctl_validfrom", "last_success_step"))
    return audit.agg(F.coalesce(latest["last_success_step"], F.lit(0)).alias("last_step"))


def previous_count(audit: DataFrame) -> DataFrame:
    """One row, ``previous``: the row count the latest run stored. Of runs with
    the same start the highest load id decides; NULL when no run is recorded."""
    latest = F.max(F.struct("ctl_validfrom", "ctl_loading", "count_rows"))
    return audit.agg(latest["count_rows"].alias("previous"))


def change_of_run(audit: DataFrame, mart: DataFrame, force: bool = False) -> DataFrame:
    """One row: ``previous`` and ``current`` row counts and the change flag."""
    return _change(audit, count_where(mart, alias="current").scalar(), force)


def _change(audit: DataFrame, current: Column, force: bool) -> DataFrame:
    return (
        previous_count(audit)
        .withColumn("current", current)
        .withColumn("is_change", change_flag("previous", "current", force))
    )


def partitions_to_count(times: dict[str, tuple[str, int]], known: dict, written: dict[str, int]) -> list[str]:
    """Partitions whose rows neither this run's writes nor an earlier count
    tell: new ones, and those that others changed since."""

    def is_known(name: str, modified: int) -> bool:
        row = known.get(name)
        return row is not None and modified and row["modified"] == modified and modified < row["counted"] - _SETTLED_MS

    return sorted(name for name, (_, modified) in times.items() if name not in written and not is_known(name, modified))


def rows_of(spark: SparkSession, table: str, partitions: list[str]) -> DataFrame:
    """``(partition, n_rows)`` of the named partitions. Their folders alone are
    read, and of those no column."""
    facts = table_facts(spark, table)
    keys, rows = facts.partition_columns, spark.table(table)
    values = [[stored_value(part.split("=", 1)[1]) for part in name.split("/")] for name in partitions]
    schema = T.StructType([T.StructField(f"__{i}", T.StringType()) for i in range(len(keys))]).add("partition", T.StringType())
    named = literal_rows(spark, [(*v, name) for v, name in zip(values, partitions, strict=True)], schema)
    for i, key in enumerate(keys):
        own = {v[i] for v in values}
        wanted = F.col(key).isin(sorted(own - {None}))
        rows = rows.where(wanted | F.col(key).isNull() if None in own else wanted)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    same = [F.col(key).cast("string").eqNullSafe(F.col(f"__{i}")) for i, key in enumerate(keys)]
    return counts.join(F.broadcast(named), reduce(and_, same)).select("partition", "n_rows")


def current_rows(spark: SparkSession, table: str, counts_table: str, written: dict[str, int] | None = None) -> int:
    """Rows of a partitioned table. Counts are kept by partition; only those
    are counted anew whose folder changed since and whose rows the run's own
    write did not count. Names and counts reach the driver, no rows."""
    facts = table_facts(spark, table)
    times = folder_times(spark, facts.location, len(facts.partition_columns))
    listed = {r["partition"] for r in list_partitions(spark, table).collect()}
    times = {name: found for name, found in times.items() if name in listed}
    known = {r["partition"]: r for r in spark.table(counts_table).collect()}
    written = {name: n for name, n in (written or {}).items() if name in times}
    asked = partitions_to_count(times, known, written)
    now = int(time.time() * 1000)
    found = {r["partition"]: r["n_rows"] for r in rows_of(spark, table, asked).collect()} if asked else {}
    rows = []
    for name, (_, modified) in sorted(times.items()):
        if name in written or name in asked:
            rows.append((name, modified, now, written.get(name, found.get(name, 0))))
        else:
            rows.append(tuple(known[name][c] for c in COUNTS_SCHEMA.fieldNames()))
    overwrite_table(literal_rows(spark, rows, COUNTS_SCHEMA).coalesce(1), counts_table)
    return sum(row[-1] for row in rows)


def record_run(
    spark: SparkSession,
    audit_table: str,
    mart_table: str,
    load_id: int,
    run_start: str,
    newest_partition: str | None,
    force: bool,
    last_success_step: int,
    steps_in_general: int,
    counts_table: str | None = None,
    written: dict[str, int] | None = None,
) -> dict:
    """Append this run's audit row and return it. With ``counts_table`` the
    mart's rows are counted partition by partition, see ``current_rows``;
    without it, all at once."""
    audit = spark.table(audit_table)
    if counts_table:
        current = F.lit(current_rows(spark, mart_table, counts_table, written)).cast("bigint")
        change = _change(audit, current, force).first()
    else:
        change = change_of_run(audit, spark.table(mart_table), force).first()
    row = {
        "ctl_loading": load_id,
        "ctl_validfrom": run_start,
        "partitions": newest_partition,
        "is_force_load": int(force),
        "last_success_step": last_success_step,
        "last_step_in_general": steps_in_general,
        "count_rows": change["current"],
        "is_change": change["is_change"],
    }
    append_row(spark, audit_table, **row)
    return row


def run_stats(
    spark: SparkSession,
    load_id: int,
    entity_id: int,
    run_start: str,
    newest_date: str | None,
    is_change: int,
    today: str | None = None,
) -> DataFrame:
    """The five statistics of a run, one row each, as ``RUN_STATS_SCHEMA``."""
    values = {
        STAT_TODAY: today or session.run_start(spark)[:DATE_LENGTH],
        STAT_CHANGE: str(is_change),
        STAT_NEWEST_DATE: newest_date,
        STAT_RUN_START: run_start,
        STAT_APPLICATION: spark.sparkContext.applicationId,
    }
    rows = [(load_id, entity_id, stat_id, value) for stat_id, value in values.items()]
    return literal_rows(spark, rows, RUN_STATS_SCHEMA)


def write_run_stats(stats: DataFrame, table: str) -> None:
    """Append the few rows of one run as one file."""
    stats.coalesce(1).write.insertInto(table, overwrite=False)
