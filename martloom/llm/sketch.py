"""Document fingerprints by threshold-scaled sketches.

Shingles are runs of ``SHINGLE_CHARS`` code points, or the whole text if it is
shorter. A sketch keeps every distinct shingle hash below a fixed fraction,
1 / ``SCALE``, of their range, so it grows with the document, the sketch of a
union is the union of the sketches, and the share of one sketch found in
another estimates containment however unequal the documents are. A text whose
hashes all lie above the threshold keeps its least one, so that only texts
without any character have empty sketches.

Likeness is the share of the smaller sketch that the other has: 1 for two
empty ones, 0 if only one is empty.

``edited_pairs`` compares each document with an edited copy and with its
successor in order of id. Rows are dealt to ranges of ids; the first row of
each range also goes to the range before it, so a range needs no other, and
the table is shuffled once. Equal ids are ordered by a hash of the text, and an
id that fills several ranges is divided by that hash. NULL ids come first.
NULL texts are empty. The last document is followed by the first.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import shared_value, ship

SHINGLE_CHARS = 12
SCALE = 16
RANGES = 512
# Code points of text in a range of ids.
RANGE_CHARS = 64 << 20
# What the cuts may be off by, at the most, is one in so many rows.
_ACCURACY = 200_000
# Code points hashed at once, so that memory does not grow with a text.
_SLICE = 262_144
# An odd base, its inverse modulo 2 ** 64, and a final mix.
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class _Powers:
    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 4096)
            made = []
            for base in (_BASE, _INVERSE):
                row = np.full(size, base, np.uint64)
                row[0] = 1
                made.append(np.cumprod(row, dtype=np.uint64))
            cls.up, cls.down = made
        return cls.up[:n], cls.down[:n]


def shingle_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` code points, from running sums of
    code points times powers of a base."""
    n = len(codes)
    up, down = _Powers.of(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    h = (sums[size:] - sums[:-size]) * down[: n - size + 1]
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def sketch(text: str, size: int = SHINGLE_CHARS, scale: int = SCALE) -> np.ndarray:
    """Sorted distinct hashes below the threshold, or the least one."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(codes):
        return np.empty(0, np.uint64)
    size = min(size, len(codes))
    highest = np.uint64((1 << 64) // scale - 1)
    kept, least = [], None
    for start in range(0, len(codes) - size + 1, _SLICE):
        hashes = shingle_hashes(codes[start : start + _SLICE + size - 1], size)
        kept.append(hashes[hashes <= highest])
        low = hashes.min()
        least = low if least is None or low < least else least
    found = np.unique(np.concatenate(kept))
    return found if len(found) else np.array([least], np.uint64)


def shown(hashes: np.ndarray) -> str:
    """A sketch as text: 16 hex digits a hash, in order."""
    return hashes.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def sketch_udf(size: int = SHINGLE_CHARS, scale: int = SCALE):
    """text -> array of hashes, as signed integers."""
    ship()

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def sketches(texts: pa.Array) -> pa.Array:
        return pa.array([sketch(t.as_py() or "", size, scale).view(np.int64) for t in texts], pa.list_(pa.int64()))

    return sketches


def below(sketch: Column, scale: int = SCALE) -> Column:
    """The hashes of a sketch below the threshold, without a kept least one."""
    if scale == 1:
        return sketch
    return F.filter(sketch, lambda h: h.between(0, (1 << 64) // scale - 1))


def containment(a: str, b: str, scale: int = SCALE) -> Column:
    """The share of sketch column ``a`` that column ``b`` has. NULL if ``a`` is
    empty, or has nothing below the threshold while ``b`` does, which then
    holds nothing else: such a short text's share cannot be told."""
    own, other = below(F.col(a), scale), below(F.col(b), scale)
    told = F.size(F.array_intersect(own, other)) / F.nullif(F.size(own), F.lit(0))
    whole = F.size(F.array_intersect(a, b)) / F.nullif(F.size(a), F.lit(0))
    return F.when(F.size(own) + F.size(other) > 0, told).otherwise(whole)


def merged(sketches: DataFrame, keys: list[str], column: str, scale: int = SCALE) -> DataFrame:
    """Sketches of the unions of groups of documents: the hashes below the
    threshold, or the least one if there is none."""
    hashes = sketches.select(*keys, F.explode_outer(column).alias(column))
    together = hashes.groupBy(*keys).agg(F.array_sort(F.collect_set(column)).alias(column))
    kept, sign = below(F.col(column), scale), F.lit(-(1 << 63))
    # Unsigned order is the signed one of the numbers with the highest bit turned.
    least = F.array_min(F.transform(column, lambda h: h.bitwiseXOR(sign))).bitwiseXOR(sign)
    alone = F.when(F.size(column) > 0, F.array(least)).otherwise(F.col(column))
    return together.withColumn(column, F.when(F.size(kept) > 0, kept).otherwise(alone))


class _Ranges:
    """Ranges of (id, hash) as numbers in the same order."""

    def __init__(self, cuts: list[int]):
        repeated = {a for a, b in zip(cuts, cuts[1:], strict=False) if a == b}
        # An id that fills more than a range gets its own, in 64 parts.
        self.cuts = np.array(sorted({*cuts, *(c + 1 for c in repeated)}), np.int64)
        self.divided = np.array(sorted(repeated), np.int64)
        self.before: dict[int, int] = {}
        self.first: dict[int, tuple] = {}

    def number(self, ids: pa.Array, hashes: np.ndarray) -> np.ndarray:
        absent = ids.is_null().to_numpy(zero_copy_only=False)
        values = ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
        divided = np.isin(values, self.divided) | absent
        at = np.where(absent, 0, np.searchsorted(self.cuts, values, side="right") + 1)
        return at * 64 + np.where(divided, (hashes >> 58) + 32, 0)


def _range_udf(ranges):
    @F.arrow_udf(T.LongType())
    def number(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        return pa.array(ranges.value.number(ids, hashes.to_numpy(zero_copy_only=False)))

    return number


def _placed_udf(ranges):
    """(id, hash) to the row's range, and to the one before if it is first."""

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("range", T.LongType()), T.StructField("guest", T.BooleanType())])))
    def places(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        known = ranges.value
        own = known.number(ids, hashes.to_numpy(zero_copy_only=False)).tolist()
        out = []
        for r, i, h in zip(own, ids.to_pylist(), hashes.to_pylist(), strict=True):
            row = [{"range": r, "guest": False}]
            if known.first[r] == (i, h):
                row.append({"range": known.before[r], "guest": True})
            out.append(row)
        return pa.array(out, pa.list_(pa.struct([("range", pa.int64()), ("guest", pa.bool_())])))

    return places


_RESULT = T.StructType(
    [
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def _compared(size: int, scale: int):
    """Rows (range, guest, id, text) in order to results; holds two rows."""

    def run(batches):
        held, at, closed = None, None, False
        for batch in batches:
            out = {name: [] for name in ("id", *_RESULT.names)}
            for r, guest, i, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True
            ):
                if r != at:
                    held, at, closed = None, r, False
                if closed:
                    continue
                text = text.as_py() or ""
                own = sketch(text, size, scale)
                if held:
                    last, last_text, last_sketch = held
                    n = len(last_text)
                    edited = last_text[: n - n // 4] + text[: n // 4]
                    new = sketch(edited, size, scale)
                    values = (
                        last, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        shown(last_sketch), shown(new), likeness(last_sketch, new), likeness(last_sketch, own),
                    )
                    for name, value in zip(out, values, strict=True):
                        out[name].append(value)
                held, closed = (i, text, own), guest
            kinds = [batch.schema.field(2).type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kind) for v, kind in zip(out.values(), kinds, strict=True)], names=list(out)
            )

    return run


def edited_pairs(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE_CHARS,
    scale: int = SCALE,
    ranges: int | None = None,
) -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)`` of every row. In the edited text, as many of the
    first code points of the next document replace the last quarter. Ids are
    integers. There are ``ranges`` ranges of them, else one for each
    ``RANGE_CHARS`` of text, and ``RANGES`` at least."""
    spark = docs.sparkSession
    ship()
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    size_of = rows.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = math.ceil(size_of / RANGE_CHARS)
    ranges, tasks = ranges or max(RANGES, blocks), max(blocks, 8 * spark.sparkContext.defaultParallelism)
    steps = [(k + 1) / ranges for k in range(ranges - 1)]
    cuts = rows.agg(F.percentile_approx("id", steps, min(20 * ranges, _ACCURACY))).first()[0] or []
    known = _Ranges([int(c) for c in cuts])
    number = _range_udf(shared_value(spark, known))
    # The first row of each range: at most 64 rows for each cut.
    firsts = (
        rows.select(number("id", "h").alias("range"), "id", "h")
        .groupBy("range")
        .agg(F.min(F.struct("id", "h")).alias("first"))
        .collect()
    )
    order = sorted(r["range"] for r in firsts)
    known.before = {r: order[i - 1] for i, r in enumerate(order)}
    known.first = {r["range"]: (r["first"]["id"], r["first"]["h"]) for r in firsts}
    places = _placed_udf(shared_value(spark, known))
    dealt = (
        rows.withColumn("place", F.explode(places("id", "h")))
        .select(F.col("place.range").alias("range"), F.col("place.guest").alias("guest"), "id", "text", "h")
        .repartition(tasks, "range")
        .sortWithinPartitions("range", "guest", "id", "h")
        .select("range", "guest", "id", "text")
    )
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *_RESULT.fields])
    found = dealt.mapInArrow(_compared(size, scale), schema)
    return found.select(F.col("id").alias(id), *_RESULT.names)
