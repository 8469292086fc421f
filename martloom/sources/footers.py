"""What Parquet footers say, read by the driver without a Spark job. For a
handful of files: each costs one small read."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Files looked into before a Spark job is the better way.
MOST_FILES = 64
# Fixed value: where Spark's writer keeps the schema of a file.
_SCHEMA_KEY = "org.apache.spark.sql.parquet.row.metadata"


def _footer(spark: SparkSession, path: str):
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(path)
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(file, hadoop)
    return jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)


def file_rows(spark: SparkSession, path: str) -> int:
    reader = _footer(spark, path)
    try:
        return reader.getRecordCount()
    finally:
        reader.close()


def file_schema(spark: SparkSession, path: str) -> T.StructType:
    """The columns of a file: as Spark's writer noted them, or read off by
    Spark if another writer made it."""
    reader = _footer(spark, path)
    try:
        noted = reader.getFooter().getFileMetaData().getKeyValueMetaData().get(_SCHEMA_KEY)
    finally:
        reader.close()
    return T.StructType.fromJson(json.loads(noted)) if noted else spark.read.parquet(path).schema


def stored_files(df: DataFrame) -> list[str] | None:
    """The Parquet files behind a DataFrame that only selects from stored
    rows; None for any other, whose rows no footer bounds."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation":
        return None
    jvm = df.sparkSession.sparkContext._jvm
    # They come as URIs, with some characters escaped.
    files = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in df.inputFiles()]
    return files if all(f.endswith(".parquet") for f in files) else None


def rows_at_most(spark: SparkSession, files: Sequence[str], bound: int) -> bool:
    """Whether a few files hold no more than ``bound`` rows together. No, if
    there are more files than the driver looks into."""
    if len(files) > MOST_FILES:
        return False
    total = 0
    for path in files:
        total += file_rows(spark, path)
        if total > bound:
            return False
    return True
