"""The change flag of a run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def change_flag(previous: Column | str, current: Column | str, force: Column | bool = False) -> Column:
    """1 for a forced load or when the two counts differ, else 0. A missing
    previous count differs from any count."""
    previous = F.col(previous) if isinstance(previous, str) else previous
    current = F.col(current) if isinstance(current, str) else current
    force = F.lit(force) if isinstance(force, bool) else force
    return F.when(force | ~previous.eqNullSafe(current), F.lit(1)).otherwise(F.lit(0))
