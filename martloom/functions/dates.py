"""Run timestamps as text, and the retention cutoff."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.config import Lifetime

# Fixed value: run timestamps are stored as text in this form.
RUN_START_FORMAT = "yyyy-MM-dd HH:mm:ss"


def run_start_text(ts: Column | str) -> Column:
    return F.date_format(ts, RUN_START_FORMAT)


def run_start_timestamp(text: Column | str) -> Column:
    return F.to_timestamp(text, RUN_START_FORMAT)


def retention_cutoff(ts: Column | str, lifetime: Lifetime) -> Column:
    """``ts`` minus the lifetime: years and months first, clipped to the end of
    a shorter month, then days. The result is text.

    Calendar arithmetic on the wall clock: a change to or from summer time in
    between does not move the cutoff.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    months = F.make_ym_interval(F.lit(lifetime.years), F.lit(lifetime.months))
    days = F.make_dt_interval(F.lit(lifetime.days))
    cutoff = ts.cast("timestamp_ntz") - months - days
    return F.substring(cutoff.cast("string"), 1, len("yyyy-MM-dd HH:mm:ss"))
