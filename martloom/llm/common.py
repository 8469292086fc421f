"""What several operators share: the learning fold, stored intermediate
tables, and links to groups."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import martloom
from martloom.session import scratch_dir


def ship(spark: SparkSession | None = None) -> None:
    """Send this package to the Python workers, once per application, so that
    it need not be installed where they run. Arrow batches are bounded by the
    session's ``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB by
    default. Called wherever functions for the workers are made."""
    spark = spark or SparkSession.active()
    context, root = spark.sparkContext, Path(martloom.__file__).parent
    if getattr(context, "_martloom_sent", False) or not root.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="martloom-")) / "martloom.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, Path("martloom") / file.relative_to(root))
    context.addPyFile(str(path))
    context._martloom_sent = True


def fold(doc_id: str | Column, folds: int = 3) -> Column:
    """crc32 of the id's text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds


def held_out(doc_id: str | Column) -> Column:
    """Whether a row is kept from learning; a NULL id is not."""
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read back, so
    that it is computed once and survives lost executors. The folder goes when
    the application ends."""
    return _stored_at(df)[0]


def _stored_at(df: DataFrame) -> tuple[DataFrame, str]:
    spark, path = df.sparkSession, scratch_dir(df.sparkSession)
    df.write.parquet(path)
    system, folder = _file_system(spark, path)
    system.deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path), path


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def shared_value(spark: SparkSession, value):
    """``value`` sent once to each executor. For values of a size bounded by a
    parameter only."""
    return spark.sparkContext.broadcast(value)


def connected_groups(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``: root is the least
    node that can be reached.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each
    step points neighbours at the least one around, so a chain of n links takes
    about log n rounds. No row holds a neighbour list, so a hub costs no more
    than its links; the last round changes nothing. Each round is stored, and
    the one before removed.
    """
    a, b = F.col("a"), F.col("b")
    edges, path = _stored_at(
        links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Large star: every larger neighbour points at the least one around.
        large = (
            both.where(b > a)
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where(a != b)
            .distinct()
        )
        # Small star: all smaller neighbours, and the node, point at the least.
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a")
            .select(F.explode(F.array(F.struct(a.alias("a"), F.col("m").alias("b")), F.struct(b.alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where(a != b)
            .distinct()
        )
        edges, after = _stored_at(small)
        system, folder = _file_system(links.sparkSession, path)
        system.delete(folder, True)
        path = after
        # A sum over hashed links tells whether the set of links has changed.
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == mark:
            break
        before = mark
    # All links now go from a node to its root; roots name themselves.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
