"""Values out of partition strings such as ``platform=WEB/report_dt=2024-01-31``."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A date inside a partition string, and its length at the end of one.
DATE_PATTERN = r"\d{4}-\d{2}-\d{2}"
DATE_LENGTH = 10


def column_names(columns: str | Sequence[str] | None) -> tuple[str, ...]:
    """One name, several or none, as a tuple."""
    return (columns,) if isinstance(columns, str) else tuple(columns or ())


def partition_value(text: Column | str, name: str) -> Column:
    """Text after the first ``name=`` up to the next slash; ``''`` when absent."""
    return F.regexp_extract(text, f"{re.escape(name)}=([^/]*)", 1)


def report_date(text: Column | str) -> Column:
    """First ``dddd-dd-dd`` in the text; ``''`` when there is none."""
    return F.regexp_extract(text, DATE_PATTERN, 0)


def date_suffix(text: Column | str) -> Column:
    """Trailing ten characters, where a date-partitioned path keeps its date."""
    return F.right(F.col(text) if isinstance(text, str) else text, F.lit(DATE_LENGTH))


def in_date_suffix_range(text: Column | str, from_date: str = "", to_date: str = "") -> Column:
    """Whether the date suffix lies in ``[from_date, to_date]``; ``''`` is open."""
    suffix = date_suffix(text)
    inside = suffix >= from_date
    return inside & (suffix <= to_date) if to_date else inside
