"""Multi-step jobs: numbered groups of independent table writes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from martloom.config import BLOCK_BYTES
from martloom.operators.sinks import overwrite_partitions, overwrite_table
from martloom.plans.audit import last_step

# Seconds between two calls to cancel the rest of a group.
_ASK_AGAIN = 0.2


@dataclass(frozen=True)
class Step:
    """One table and the function ``(spark, params) -> DataFrame`` of its rows.
    ``rebalance`` suits results of many dates, ``"blocks"`` those of one, see
    ``overwrite_partitions``. ``whole`` replaces all rows of an unpartitioned
    table."""

    table: str
    transform: Callable[[SparkSession, Mapping], DataFrame]
    on_overflow: str = "raise"
    rebalance: bool | str = True
    whole: bool = False
    block_bytes: int = BLOCK_BYTES


@dataclass(frozen=True)
class StepsOutcome:
    last_success: int
    in_general: int
    error: BaseException | None = None
    # Rows by table and partition, where a write went to one partition.
    written: dict[str, dict[str, int]] = field(default_factory=dict)

    @property
    def complete(self) -> bool:
        return self.last_success == self.in_general


def resume_after(spark: SparkSession, audit_table: str, recovery: bool) -> int:
    """Number of the last step to skip: 0 unless recovering."""
    if not recovery:
        return 0
    return last_step(spark.table(audit_table)).first()["last_step"]


def run_steps(
    spark: SparkSession,
    groups: Mapping[int, Sequence[Step]],
    params: Mapping,
    done: int = 0,
) -> StepsOutcome:
    """Run the groups in ascending order, skipping those up to ``done``.

    The tables of a group do not depend on each other: their writes are
    submitted together, each in a scheduler pool of its own, so that where
    ``spark.scheduler.mode`` is FAIR a long one does not hold up the others.
    The first failed write cancels the others of its group, whose tables keep
    what they had, and ends the run; its error is in the outcome, not raised,
    so that the caller can record it.
    """
    total = len(groups)
    if sorted(groups) != list(range(1, total + 1)):
        raise ValueError(f"steps must be numbered 1..{total} without gaps, got {sorted(groups)}")
    context, written = spark.sparkContext, {}

    def write(step: Step, tag: str) -> None:
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", step.table)
        rows = step.transform(spark, params)
        if step.whole:
            overwrite_table(rows, step.table, step.on_overflow)
        else:
            found = overwrite_partitions(rows, step.table, step.on_overflow, step.rebalance, step.block_bytes)
            if found:
                written.setdefault(step.table, {}).update(found)

    done = min(done, total)
    for number in range(done + 1, total + 1):
        steps = groups[number]
        if steps:
            tag = f"martloom-{uuid.uuid4().hex}"
            with ThreadPoolExecutor(len(steps)) as pool:
                # A wrapper for each: its properties are the thread's own.
                writes = [pool.submit(inheritable_thread_target(spark)(write), step, tag) for step in steps]
                ended, going = wait(writes, return_when=FIRST_EXCEPTION)
                errors = [error for w in ended if (error := w.exception()) is not None]
                while going:
                    # A write between two jobs submits its next one, so ask again.
                    context.cancelJobsWithTag(tag)
                    _, going = wait(going, timeout=_ASK_AGAIN)
            if errors:
                return StepsOutcome(done, total, errors[0], written)
        done = number
    return StepsOutcome(done, total, None, written)
