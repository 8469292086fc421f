"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

from martloom.config import BLOCK_BYTES
from martloom.functions.dates import RUN_START_FORMAT

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Only the partitions present in a result are replaced. Tables declared by
    # this library carry the same option, so that they do not depend on it.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Steps of a group share the executors, each table in a pool of its own.
    "spark.scheduler.mode": "FAIR",
    # A shuffle whose input comes back different after a lost executor is
    # recomputed whole instead of mixing two versions of the rows.
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
    "spark.hadoop.dfs.blocksize": str(BLOCK_BYTES),
    "spark.hadoop.parquet.block.size": str(BLOCK_BYTES),
}


def build_session(
    app_name: str,
    conf: dict[str, str] | None = None,
    hive: bool = False,
    input_bytes: int | None = None,
) -> SparkSession:
    """A session with this library's defaults; ``conf`` wins over them.

    ``input_bytes`` is what the largest join reads. Shuffles then start with
    one partition per block of it, and adaptive execution merges small ones.
    """
    sized = {}
    if input_bytes:
        start = max(200, math.ceil(input_bytes / BLOCK_BYTES))
        sized["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(start)
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **sized, **(conf or {})}.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def run_start(spark: SparkSession) -> str:
    """The current time in the session's zone as ``yyyy-MM-dd HH:mm:ss``."""
    time = spark.sparkContext._jvm.java.time
    now = time.LocalDateTime.now(time.ZoneId.of(spark.conf.get("spark.sql.session.timeZone")))
    return now.format(time.format.DateTimeFormatter.ofPattern(RUN_START_FORMAT))


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name under the shared folder that the session names.

    A local session without one may use a temporary folder; on a cluster the
    executors could not see it, so the setting is required there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="martloom-")
    return f"{shared.rstrip('/')}/martloom/{uuid.uuid4().hex}"
