"""Left outer equi-join that stays balanced when a right key holds many rows.

Spark picks the join (broadcast under its own size threshold, else
sort-merge), and adaptive execution splits a left partition that is too large,
NULL keys included; so a session without it is refused. The right side of a
left outer join it cannot split. There, a key with more rows than one task can
hold is dealt to pieces at random, and a left row of that key is copied to
each piece, so that every pair meets once.

Which keys those are is found when the join is set up. A right side whose
footers count no more rows than a task can hold has none, and no job runs. Else
its rows are counted by hash bucket, so that a task shuffles a fixed number of
partial sums whatever the table holds; a bucket below the limit has no heavy
key, and only the keys of the others are counted one by one.

If the right table changes after that, rows are still joined as the tables then
are: a key that is gone by then gets no copies.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.sources.footers import rows_at_most, stored_files
from martloom.sources.literals import literal_rows

_RIGHT = "__right_key"
_HOT = "__hot_key"
_PIECES = "__pieces"
_PIECE = "__piece"
_BUCKET = "__bucket"
# Heavy keys stated in the plan; more are counted again by the query.
_STATED_KEYS = 10_000


@dataclass(frozen=True)
class HotKeys:
    """``rows_per_task``: a right key with more rows is split into pieces of
    about that many. Up to ``broadcast_keys`` such keys are sent to every
    executor, about 50 bytes each; more are joined as Spark sees fit. Keys are
    first counted in ``buckets`` buckets."""

    rows_per_task: int = 5_000_000
    broadcast_keys: int = 1_000_000
    buckets: int = 1 << 20

    def __post_init__(self):
        if self.rows_per_task < 1 or self.buckets < 1:
            raise ValueError("rows_per_task and buckets must be positive")


def _bucket(key: str, policy: HotKeys) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(policy.buckets)).cast("int")


def heavy_buckets(right: DataFrame, key: str, policy: HotKeys) -> DataFrame:
    """Buckets of keys with more rows than a task can hold. Each task shuffles
    one partial sum for each bucket at most."""
    counts = right.where(F.col(key).isNotNull()).groupBy(_bucket(key, policy).alias(_BUCKET)).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > policy.rows_per_task).select(_BUCKET)


def hot_keys_of(right: DataFrame, key: str, policy: HotKeys) -> DataFrame:
    """``(key, pieces)`` of the keys that one task cannot hold. Only keys in
    heavy buckets, of which there are no more than buckets, are counted."""
    heavy = F.broadcast(heavy_buckets(right, key, policy))
    among = right.join(heavy, _bucket(key, policy) == heavy[_BUCKET], "left_semi").where(F.col(key).isNotNull())
    counts = among.groupBy(F.col(key).alias(_HOT)).agg(F.count("*").alias("n"))
    pieces = F.ceil(F.col("n") / policy.rows_per_task).cast("int")
    return counts.where(F.col("n") > policy.rows_per_task).select(_HOT, pieces.alias(_PIECES))


def _found_hot_keys(right: DataFrame, policy: HotKeys) -> DataFrame | None:
    """The hot keys as the plan needs them; None if there are none."""
    spark, files = right.sparkSession, stored_files(right)
    if files is not None and rows_at_most(spark, files, policy.rows_per_task):
        return None
    if not heavy_buckets(right, _RIGHT, policy).head(1):
        return None
    hot = hot_keys_of(right, _RIGHT, policy)
    rows = hot.limit(_STATED_KEYS + 1).collect()
    if not rows:
        return None
    if files is None:
        _require_whole_retries(right)
    if len(rows) > _STATED_KEYS:
        return F.broadcast(hot) if hot.count() <= policy.broadcast_keys else hot
    stated = F.broadcast(literal_rows(spark, rows, hot.schema))
    # Only those that the right side still has when the query runs.
    here = right.join(stated, right[_RIGHT] == stated[_HOT]).select(_HOT, _PIECES).distinct()
    return F.broadcast(here)


def _common_type(left: T.DataType, right: T.DataType, frame: DataFrame) -> T.DataType:
    """What both keys are compared as."""
    if left == right:
        return left
    numbers = all(isinstance(t, T.NumericType) for t in (left, right))
    times = all(isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) for t in (left, right))
    if not numbers and not times:
        raise ValueError(f"cast the keys to one type: {left.simpleString()} and {right.simpleString()}")
    both = F.coalesce(F.lit(None).cast(left), F.lit(None).cast(right))
    return frame.select(both.alias("k")).schema["k"].dataType


def _require_adaptive(df: DataFrame) -> None:
    conf = df.sparkSession.conf
    for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        if conf.get(name).lower() != "true":
            raise ValueError(f"{name} is off: nothing would split a heavy left key; pass hot_keys=None to accept that")


def _require_whole_retries(df: DataFrame) -> None:
    """Rows are dealt to pieces by chance. Over stored files a repeated task
    deals them alike; over derived rows, in another order, it would not, and
    must not be mixed with what the first one dealt."""
    for name in ("enabled", "enableFullRetryOnMismatch"):
        key = f"spark.sql.shuffle.orderIndependentChecksum.{name}"
        if df.sparkSession.conf.get(key, "false").lower() != "true":
            raise ValueError(f"{key} is off: write the right side to a table first, or pass hot_keys=None")


def left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    columns: list[str] | tuple[str, ...],
    hot_keys: HotKeys | None = HotKeys(),
) -> DataFrame:
    """All columns of ``left`` and the named ones of ``right``.

    Left rows are always kept, NULL keys included; unmatched rows get NULLs;
    duplicate right keys multiply left rows. Keys of different number or time
    types are compared as their common type.

    Setting up the join looks for heavy right keys. That is cheap for a stored
    table; write a derived input to a table first, or pass ``hot_keys=None``,
    which leaves skew to adaptive execution.
    """
    clash = set(left.columns) & set(columns)
    if clash:
        raise ValueError(f"both sides supply {sorted(clash)}")
    common = _common_type(left.schema[left_key].dataType, right.schema[right_key].dataType, left)
    right = right.select(F.col(right_key).cast(common).alias(_RIGHT), *columns)
    key = left[left_key].cast(common)
    if hot_keys is not None:
        _require_adaptive(left)
        hot = _found_hot_keys(right, hot_keys)
        if hot is not None:
            return _split(left, right, key, columns, hot)
    return left.join(right, key == right[_RIGHT], "left").drop(_RIGHT)


def _split(left: DataFrame, right: DataFrame, key: Column, columns, hot: DataFrame) -> DataFrame:
    pieces = F.coalesce(_PIECES, F.lit(1))
    dealt = (
        right.join(hot, right[_RIGHT] == hot[_HOT], "left")
        .withColumn(_PIECE, F.floor(F.rand(seed=7) * pieces).cast("int"))
        .select(_RIGHT, _PIECE, *columns)
    )
    copied = left.join(hot, key == hot[_HOT], "left").withColumn(_PIECE, F.explode(F.sequence(F.lit(0), pieces - 1)))
    joined = copied.join(dealt, (key == dealt[_RIGHT]) & (copied[_PIECE] == dealt[_PIECE]), "left")
    # A copy in a piece that got no row goes; the others of its row have met.
    return joined.where(F.col(_PIECES).isNull() | F.col(_RIGHT).isNotNull()).select(*left.columns, *columns)
