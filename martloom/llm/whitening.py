"""Embedding whitening by spectrum slicing.

Entries become whole numbers, floor(scale * c). Every distinct vector counts
once: their number n, their sums S and their covariance V are gathered by
partial sums, V from differences to the mean, which are taken in integers.

The leading eigenvalues of V are found one by one. An LDL' factorisation of
V - s I (Bunch and Kaufman's pivots) has as many positive pivots as V has
eigenvalues above s, by Sylvester's law of inertia. Bisection over s isolates
the k-th largest one; Rayleigh quotient iteration from there converges
cubically; and two more counts, just below and above the result, certify that
it is the k-th. Eigenvalues that no shift can part have their vectors kept
orthogonal to each other.

Only V, a square of the vectors' length, and one row of sums a task's
dimension reach the driver; their size does not depend on the rows.

Rows whose vector is NULL or holds NULL, NaN or infinity are dropped. Shorter
vectors are continued by zeros. Repeated rows each have their result, and count
once in the covariance; a NULL id is kept. Vectors of fewer dimensions than
components have as many components. A component without variance whitens to 0,
and the identity error says so. No rows in, no rows out. Entries whose floor no
64-bit integer holds become the nearest one. ``deviation`` is NULL where a
64-bit integer cannot hold it; ``deviation_text`` always has its digits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm import vectors
from martloom.llm.common import ship, shared_value, stored

SCALE = 256
COMPONENTS = 4
# Bunch and Kaufman's bound for the growth of entries.
_ALPHA = (1 + 17**0.5) / 8
_EPS = np.finfo(np.float64).eps
_LIMB = 24


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above ``shift``: the
    positive pivots of an LDL' factorisation of ``matrix - shift I``."""
    a = np.array(matrix, np.float64)
    n = len(a)
    a[np.diag_indices(n)] -= shift
    positive = k = 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1 :, k])
        largest = below.max(initial=0.0)
        two = False
        if abs(a[k, k]) < _ALPHA * largest:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[k:, r])
            row[r - k] = 0
            other = row.max()
            if abs(a[k, k]) * other < _ALPHA * largest**2:
                if abs(a[r, r]) >= _ALPHA * other:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:
            block, rest = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            # Such a pivot block has one eigenvalue of either sign.
            positive += 1
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(block, rest.T)
            k += 2
        else:
            pivot = a[k, k]
            positive += pivot > 0
            if pivot != 0:
                column = a[k + 1 :, k].copy()
                a[k + 1 :, k + 1 :] -= np.outer(column, column / pivot)
            k += 1
    return int(positive)


class _Slices:
    """Counts at shifts, each computed once."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, self.known = matrix, {}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = count_above(self.matrix, shift)
        return self.known[shift]

    def around(self, k: int, low: float, high: float) -> tuple[float, float]:
        """The narrowest known interval that holds the k-th largest."""
        lows = [s for s, c in self.known.items() if c >= k]
        highs = [s for s, c in self.known.items() if c < k]
        return max(lows, default=low), min(highs, default=high)


def _solved(matrix: np.ndarray, shift: float, v: np.ndarray, size: float) -> np.ndarray:
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        w = np.linalg.solve(shifted, v)
    except np.linalg.LinAlgError:
        w = np.linalg.solve(shifted + 2 * _EPS * size * np.eye(len(matrix)), v)
    return w / np.abs(w).max()


def _unit(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for u in others:
            v = v - (u @ v) * u
    return v / np.linalg.norm(v)


def leading_pairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and
    their unit vectors as columns. Raises if a count contradicts a number."""
    n = len(matrix)
    size = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if size == 0:
        return np.zeros(count), np.eye(n)[:, :count]
    scaled = matrix / size
    slices, floor = _Slices(scaled), 4 * n * _EPS
    draw = np.random.default_rng(11)
    values, found = [], []
    for k in range(1, count + 1):
        low, high = slices.around(k, -1.0 - floor, 1.0 + floor)
        while True:
            low, high = slices.around(k, low, high)
            middle = (low + high) / 2
            tight = high - low <= floor
            lone = slices.above(high) == k - 1 and slices.above(low) == k
            if not lone and not tight:
                slices.above(middle)
                continue
            # Vectors of eigenvalues that cannot be told from this one.
            near = [u for u, value in zip(found, values, strict=True) if tight or value - high <= floor]
            v = _unit(draw.standard_normal(n), near)
            for _ in range(3):
                v = _unit(_solved(scaled, middle, v, 1.0), near)
            quotient = float(v @ scaled @ v)
            if not tight:
                for _ in range(12):
                    residual = np.linalg.norm(scaled @ v - quotient * v)
                    if residual <= 2 * _EPS or not low < quotient < high:
                        break
                    better = _unit(_solved(scaled, quotient, v, 1.0), [])
                    moved = float(better @ scaled @ better)
                    if residual <= floor and np.linalg.norm(scaled @ better - moved * better) >= residual:
                        break
                    v, quotient = better, moved
            residual = float(np.linalg.norm(scaled @ v - quotient * v))
            if tight or (low < quotient < high and residual <= floor):
                break
            slices.above(middle)
        margin = 2 * max(residual, floor)
        if count_above(scaled, quotient + margin) >= k or count_above(scaled, quotient - margin) < k:
            raise ArithmeticError(f"counts do not certify eigenvalue {k}")
        values.append(quotient)
        # Vectors of close eigenvalues lean on each other by rounding.
        found.append(_unit(v, found))
    return np.array(values) * size, np.column_stack(found)


@dataclass(frozen=True)
class Whitening:
    """What a fit found. ``sums`` are exact; ``vectors`` has a unit column for
    each component; ``trace`` is the sum of all variances."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def width(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n as doubles, the whole part of the mean taken off exactly."""
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        if max((abs(w) for w in whole), default=0) < 2**61 and np.abs(x.astype(np.float64)).max(initial=0.0) < 2.0**61:
            return (x - np.array(whole, np.int64)).astype(np.float64) - rest
        return (x.astype(object) - np.array(whole, object)).astype(np.float64) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        usable = self.values > self.width * _EPS * self.values.max(initial=0.0)
        scale = np.where(usable, 1 / np.sqrt(np.where(usable, self.values, 1.0)), 0.0)
        return self.centred(x) @ self.vectors * scale

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum over dimensions of (n x - S) ** 2 for each row, exactly:
        n n xx - 2 n xS + SS, with xS from pieces of S that fit a product."""
        n, sums = self.n, np.array(self.sums, object)
        largest = float(np.abs(x.astype(np.float64)).max(initial=0.0))
        if largest * max(largest, 2.0**_LIMB) * max(self.width, 1) >= 2.0**62:
            return [sum((n * int(v) - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        squares = (x * x).sum(axis=1).astype(object)
        dots, sign = np.zeros(len(x), object), np.array([1 if s >= 0 else -1 for s in self.sums], np.int64)
        left, place = np.array([abs(s) for s in self.sums], object), 0
        while any(left):
            piece = np.array([int(v) & ((1 << _LIMB) - 1) for v in left], np.int64)
            dots = dots + (x @ (piece * sign)).astype(object) * (1 << place)
            left, place = np.array([int(v) >> _LIMB for v in left], object), place + _LIMB
        return list(n * n * squares - 2 * n * dots + int((sums * sums).sum()))


def _packed(scale: int):
    def run(batches):
        for batch in batches:
            column = batch.column(0)
            column = column.filter(pa.array(vectors.finite_rows(column)))
            yield pa.RecordBatch.from_arrays([pa.array(vectors.pack(column, scale, True), pa.binary())], names=["x"])

    return run


def _sums(width: int):
    """Per task: the number of rows and the exact sum of each dimension."""

    def run(batches):
        n, sums = 0, [0] * width
        for batch in batches:
            x = vectors.unpack(batch.column(0).to_pylist(), width)
            n += len(x)
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            sums = [s + (h << 32) + l for s, h, l in zip(sums, high, low, strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, width), pa.int32()), pa.array([n, *sums], pa.decimal128(38, 0))], names=["i", "total"]
            )

    return run


def _products(width: int, of):
    """Per task: the sums of products of ``of(x)``, and of its entries in row
    ``width``."""

    def run(batches):
        n, total, plain = 0, np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            y = of(batch.column(0).to_pylist())
            n, total, plain = n + len(y), total + y.T @ y, plain + y.sum(axis=0)
        if n:
            rows, columns = np.divmod(np.arange(width * (width + 1)), max(width, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array(columns, pa.int32()), pa.array(np.append(total, plain))], names=["i", "j", "v"]
            )

    return run


def _gathered(fitted: DataFrame, width: int, of) -> tuple[np.ndarray, np.ndarray]:
    parts = fitted.mapInArrow(_products(width, of), "i int, j int, v double")
    total, plain = np.zeros((width, width)), np.zeros(width)
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        (plain if r["i"] == width else total[r["i"]])[r["j"]] = r["v"]
    return total, plain


def fit(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """The whitening of the distinct vectors; None if there is no vector."""
    spark = table.sparkSession
    ship(spark)
    # Copies meet as partial groups before the shuffle.
    fitted = stored(table.select(F.col(vector).alias("v")).mapInArrow(_packed(scale), "x binary").distinct())
    kind, length = F.substring("x", 1, 1).cast("string").cast("int"), F.length("x") - 1
    # The entries' types have 1, 2, 4 and 8 bytes.
    found = fitted.agg(F.max(length / F.pow(F.lit(2.0), kind)).alias("width")).first()["width"]
    if found is None:
        return None
    width = int(found)
    totals = fitted.mapInArrow(_sums(width), "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total"))
    sums = {r["i"]: int(r["total"]) for r in totals.collect()}
    n = sums[-1]
    model = Whitening(n, tuple(sums[i] for i in range(width)), np.zeros(0), np.zeros((width, 0)), 0.0)
    shared = shared_value(spark, model)
    total, plain = _gathered(fitted, width, lambda rows: shared.value.centred(vectors.unpack(rows, width)))
    # What the rounded mean left over.
    covariance = total / n - np.outer(plain / n, plain / n)
    covariance = (covariance + covariance.T) / 2
    count = min(components, width)
    values, axes = leading_pairs(covariance, count)
    model = Whitening(n, model.sums, values, axes, float(np.trace(covariance)))
    shared = shared_value(spark, model)
    total, plain = _gathered(fitted, count, lambda rows: shared.value.whitened(vectors.unpack(rows, width)))
    error = np.abs(total / n - np.outer(plain / n, plain / n) - np.eye(count)).max(initial=0.0)
    return Whitening(n, model.sums, values, axes, model.trace, float(error))


def _projected(shared, scale: int, names: list[str]):
    def run(batches):
        for batch in batches:
            model = shared.value
            good = pa.array(vectors.finite_rows(batch.column(1)))
            ids, column = batch.column(0).filter(good), batch.column(1).filter(good)
            x = np.zeros((len(ids), model.width), np.int64)
            for rows, values in vectors.floors(column, scale):
                x[rows[:, None], np.arange(values.shape[1])[None, :]] = vectors.as_longs(values)
            count = len(model.values)
            deviations = model.deviations(x)
            repeated = np.repeat(np.arange(len(ids)), count)
            shares = np.maximum(model.values, 0) / model.trace if model.trace > 0 else np.zeros(count)
            whitened = model.whitened(x)
            arrays = [
                ids.take(pa.array(repeated)),
                pa.array(np.tile(np.arange(1, count + 1), len(ids)), pa.int32()),
                pa.array(np.full(len(repeated), model.n), pa.int64()),
                pa.array([d if d < 2**63 else None for d in deviations], pa.int64()).take(pa.array(repeated)),
                pa.array([str(d) for d in deviations], pa.string()).take(pa.array(repeated)),
                pa.array(whitened.reshape(-1)),
                pa.array(np.tile(shares, len(ids))),
                pa.array(np.full(len(repeated), model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def whiten(
    table: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE
) -> DataFrame:
    """``(id, component, n, deviation, deviation_text, whitened, explained,
    identity_error)`` for every row with a vector and every component."""
    fields = [
        T.StructField("id", table.schema[id].dataType),
        T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()),
        T.StructField("deviation_text", T.StringType()),
        T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ]
    schema = T.StructType(fields)
    rows = table.select(F.col(id).alias("id"), F.col(vector).alias("v"))
    model = fit(table, vector, components, scale)
    if model is None:
        return rows.where(F.lit(False)).mapInArrow(lambda batches: iter(()), schema).withColumnRenamed("id", id)
    shared = shared_value(table.sparkSession, model)
    return rows.mapInArrow(_projected(shared, scale, schema.fieldNames()), schema).withColumnRenamed("id", id)
