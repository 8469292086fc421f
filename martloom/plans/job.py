"""One complete run of a mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from martloom import session
from martloom.config import RunConfig
from martloom.functions import partition_value
from martloom.operators.aggregates import last_partition
from martloom.operators.ddl import declare_table, redeclare_table
from martloom.operators.joins import HotKeys
from martloom.plans.audit import AUDIT_SCHEMA, COUNTS_SCHEMA, RUN_STATS_SCHEMA, record_run, run_stats, write_run_stats
from martloom.plans.compaction import compact_partitions, compact_table
from martloom.plans.mart import force_reload, mart_rows, resolve_date
from martloom.plans.retention import apply_retention
from martloom.plans.steps import Step, resume_after, run_steps
from martloom.sources.tables import list_partitions


class JobFailed(RuntimeError):
    """Not every step succeeded. The audit row has been written."""


@dataclass(frozen=True)
class RunReport:
    load_date: str
    audit: dict
    compacted: list[dict]
    expired: int


def declare_tables(spark: SparkSession, config: RunConfig) -> None:
    """Declare mart, audit and statistics tables; external ones
    whose definition changed are re-declared."""
    spec = config.spec
    if config.location:
        redeclare_table(spark, config.target, spec.schema, config.location, spec.partitions)
        redeclare_table(spark, config.audit_table, AUDIT_SCHEMA, config.audit_location)
    else:
        declare_table(spark, config.target, spec.schema, spec.partitions)
        declare_table(spark, config.audit_table, AUDIT_SCHEMA)
    declare_table(spark, config.statistics_table, RUN_STATS_SCHEMA)
    declare_table(spark, config.counts_table, COUNTS_SCHEMA)


def mart_step(config: RunConfig, hot_keys: HotKeys | None = HotKeys()) -> Step:
    """The mart build as a step."""

    def transform(spark: SparkSession, params: Mapping):
        return mart_rows(
            spark.table(config.profile),
            spark.table(config.reference),
            config.spec,
            params["load_date"],
            params["load_id"],
            params["run_start"],
            config.on_overflow,
            hot_keys,
        )

    return Step(config.target, transform, config.on_overflow, rebalance="blocks", block_bytes=config.block_bytes)


def run_mart_job(
    spark: SparkSession,
    config: RunConfig,
    load_id: int,
    groups: Mapping[int, Sequence[Step]] | None = None,
    run_start: str | None = None,
    force: bool = False,
    recovery: bool = False,
    today: str | None = None,
) -> RunReport:
    """Declare, resolve the date, run the steps, audit, compact, expire, publish.

    ``groups`` defaults to the mart build as the only step. A failed step still
    gets its audit row; then ``JobFailed`` is raised and maintenance is skipped.
    """
    run_start = run_start or session.run_start(spark)
    groups = groups or {1: [mart_step(config)]}
    spec = config.spec

    declare_tables(spark, config)
    if force:
        # Refuse a forced load without a date before anything is removed.
        resolve_date(spark, config.target, spec.partition_column, config.default_date, force)
        force_reload(spark, config.target, spec)
    load_date = resolve_date(spark, config.target, spec.partition_column, config.default_date, force)

    outcome = run_steps(
        spark,
        groups,
        {**config.params, "load_date": load_date, "load_id": load_id, "run_start": run_start},
        done=resume_after(spark, config.audit_table, recovery),
    )

    newest = last_partition(list_partitions(spark, config.target)).select(
        "partition", partition_value("partition", spec.partition_column).alias("value")
    ).first()
    audit = record_run(
        spark,
        config.audit_table,
        config.target,
        load_id,
        run_start,
        newest["partition"] if newest else None,
        force,
        outcome.last_success,
        outcome.in_general,
        config.counts_table,
        outcome.written.get(config.target),
    )
    if not outcome.complete:
        raise JobFailed(
            f"{config.target}: stopped after step {outcome.last_success} of {outcome.in_general}"
        ) from outcome.error

    # The step has written about a block a file; only what it left far from
    # that, or others wrote, is written again.
    compacted = compact_partitions(spark, config.target, run_start, config.block_bytes, slack=2.0)
    expired = apply_retention(
        spark, config.target, spec.partition_column, run_start, config.lifetime, recover=False
    )
    write_run_stats(
        run_stats(
            spark, load_id, config.entity_id, run_start, newest["value"] if newest else None,
            audit["is_change"], today,
        ),
        config.statistics_table,
    )
    # A file for every run would add up.
    for table in (config.audit_table, config.statistics_table):
        compact_table(spark, table, config.block_bytes)
    return RunReport(load_date, audit, compacted, expired)
