"""A handful of driver-side values as rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Rows stated in the plan itself: Spark knows their size, no Python worker
    takes part, and a lost executor has nothing to lose. For a few values, not
    for data."""
    names = schema.fieldNames()
    columns = {name: [row[i] for row in rows] for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(columns), schema)
