"""File counts for a given number of bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.config import BLOCK_BYTES


def target_file_count(size: Column | str, block_bytes: int = BLOCK_BYTES) -> Column:
    """One file, and one more for every full block."""
    size = F.col(size) if isinstance(size, str) else size
    return F.call_function("div", size, F.lit(block_bytes)) + F.lit(1)
