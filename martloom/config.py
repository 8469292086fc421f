"""Typed settings for a mart and for one run of it."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields

from pyspark.sql import types as T

# The target block size and the prefix of an audit table's name.
BLOCK_BYTES = 134217728
AUDIT_PREFIX = "kpd_report_"

_TABLE_NAME = re.compile(r"[^.\s]+\.[^.\s]+")


@dataclass(frozen=True)
class Lifetime:
    """How long a partition is kept. At least one part must be positive: an
    all-zero lifetime would expire every partition up to the run's own day."""

    days: int = 0
    months: int = 0
    years: int = 0

    def __post_init__(self):
        for part in fields(self):
            value = getattr(self, part.name)
            if isinstance(value, bool) or not isinstance(value, int) or value < 0:
                raise ValueError(f"lifetime {part.name} must be a non-negative int, got {value!r}")
        if not (self.days or self.months or self.years):
            raise ValueError("a lifetime needs at least one positive part")


@dataclass(frozen=True)
class MartSpec:
    """What a mart row is made of.

    ``schema`` lists the mart's columns in storage order. Columns named in
    ``from_reference`` come from the reference table, the two stamp columns
    from the run, everything else from the profile table.
    """

    schema: T.StructType
    profile_key: str
    reference_key: str
    from_reference: tuple[str, ...]
    partition_column: str = "report_dt"
    load_id_column: str = "ctl_loading"
    run_start_column: str = "ctl_validfrom"
    # All partition columns, outermost first, if there are more than the date.
    partition_columns: tuple[str, ...] = ()

    def __post_init__(self):
        names = self.schema.fieldNames()
        named = (*self.from_reference, *self.partitions, self.partition_column, self.load_id_column, self.run_start_column)
        unknown = [name for name in named if name not in names]
        if unknown:
            raise ValueError(f"columns missing from the mart schema: {unknown}")
        if self.partition_column not in self.partitions:
            raise ValueError(f"{self.partition_column} is not among the partition columns")

    @property
    def partitions(self) -> tuple[str, ...]:
        return self.partition_columns or (self.partition_column,)

    @property
    def from_profile(self) -> tuple[str, ...]:
        stamped = {self.load_id_column, self.run_start_column}
        return tuple(
            name
            for name in self.schema.fieldNames()
            if name not in stamped and name not in self.from_reference
        )


@dataclass(frozen=True)
class RunConfig:
    """Everything one run of a mart job needs to know."""

    target: str
    spec: MartSpec
    profile: str
    reference: str
    lifetime: Lifetime
    default_date: str = ""
    location: str | None = None
    audit_location: str | None = None
    stats_table: str | None = None
    entity_id: int = 0
    block_bytes: int = BLOCK_BYTES
    on_overflow: str = "raise"
    params: dict = field(default_factory=dict)

    def __post_init__(self):
        if not _TABLE_NAME.fullmatch(self.target):
            raise ValueError(f"target must look like db.table, got {self.target!r}")
        if self.block_bytes <= 0:
            raise ValueError("block_bytes must be positive")
        if (self.location is None) != (self.audit_location is None):
            raise ValueError("give both table locations (external tables) or neither (managed)")

    @property
    def database(self) -> str:
        return self.target.split(".")[0]

    @property
    def audit_table(self) -> str:
        database, table = self.target.split(".")
        return f"{database}.{AUDIT_PREFIX}{table}"

    @property
    def counts_table(self) -> str:
        """Rows by partition of the target, as last counted."""
        return f"{self.audit_table}_rows"

    @property
    def statistics_table(self) -> str:
        return self.stats_table or f"{self.database}.run_stats"
