"""The composite jobs: build, resume, audit, compact, expire."""

from martloom.plans.audit import (
    AUDIT_SCHEMA,
    COUNTS_SCHEMA,
    RUN_STATS_SCHEMA,
    change_of_run,
    current_rows,
    last_step,
    previous_count,
    record_run,
    run_stats,
    write_run_stats,
)
from martloom.plans.compaction import compact_partitions, compact_table, compaction_plan
from martloom.plans.job import JobFailed, RunReport, run_mart_job
from martloom.plans.mart import (
    CORPORATE_MART,
    build_mart,
    force_reload,
    mart_rows,
    newest_loaded_date,
    resolve_date,
)
from martloom.plans.retention import apply_retention, retention_plan
from martloom.plans.steps import Step, StepsOutcome, resume_after, run_steps

__all__ = [
    "AUDIT_SCHEMA",
    "CORPORATE_MART",
    "COUNTS_SCHEMA",
    "JobFailed",
    "RUN_STATS_SCHEMA",
    "RunReport",
    "Step",
    "StepsOutcome",
    "apply_retention",
    "build_mart",
    "change_of_run",
    "compact_partitions",
    "compact_table",
    "compaction_plan",
    "current_rows",
    "force_reload",
    "last_step",
    "mart_rows",
    "newest_loaded_date",
    "previous_count",
    "record_run",
    "resolve_date",
    "resume_after",
    "retention_plan",
    "run_mart_job",
    "run_stats",
    "run_steps",
    "write_run_stats",
]
