"""Centroid clustering with nearest centroids by the threshold algorithm.

Components become whole numbers, floor(scale * c), and everything after that is
integer arithmetic. In each dimension the centroids stand in a sorted list. A
vector starts at its own value in each list and walks outwards, to the nearer
side first; every centroid met is compared in full. What the lists' frontiers
add up to bounds the distance of every centroid not met yet, so the walk ends
when that sum strictly exceeds the best distance found (a centroid as near as
the best, with a smaller number, is then met before), or when all are met.

Vectors are stored once, packed. A round sends the centroids, whose size is
bounded by their number and the vectors' length, to the tasks, and gets counts
and sums for each cluster back, added up by Spark.

Rows whose vector is NULL, of another length, or holds NULL, NaN or infinity
are dropped. Repeated rows all count. Of equal starting hashes (repeated ids)
the smaller packed vector is first; NULL ids hash like ``<seed>:``. With fewer
vectors than clusters there are fewer clusters; without any, no rows. Numbers
too large for 64-bit products are handled as Python's integers; a distance or
inertia that no 64-bit integer holds is NULL.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm import vectors
from martloom.llm.common import ship, shared_value, stored
from martloom.sources.literals import literal_rows

SCALE = 1024
LENGTH = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
_FAR = np.iinfo(np.int64).max
# Sums travel in pieces of so many bits, each added up by Spark.
_PIECE = 96


class SortedLists:
    """The centroids, and for each dimension their numbers in order of value."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, 0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(number, squared distance)`` of the nearest centroid of each row;
        of equally near ones, the smaller number."""
        bound = max((int(np.abs(a).max()) for a in (x, self.centroids) if a.size), default=0)
        if 4 * bound * bound * max(x.shape[1], 1) >= _FAR:
            return SortedLists(self.centroids.astype(object))._walk(x.astype(object), 16 * bound * bound * max(x.shape[1], 1))
        return SortedLists(self.centroids.astype(np.int64))._walk(x.astype(np.int64), _FAR)

    def _walk(self, x: np.ndarray, far: int) -> tuple[np.ndarray, np.ndarray]:
        (n, width), k = x.shape, len(self.centroids)
        kind, dims = x.dtype, np.arange(width)
        best, number = np.full(n, far, kind), np.full(n, k)
        met = np.zeros((n, k), bool)
        right = np.zeros((n, width), np.int64)
        for d in dims:
            right[:, d] = np.searchsorted(self.values[:, d], x[:, d])
        left, going = right - 1, np.arange(n)
        # A list ends with a gap longer than any; each has a centroid left on
        # one side until all are met.
        while len(going):
            part = x[going]
            below = np.where(left >= 0, part - self.values[np.maximum(left, 0), dims], far)
            above = np.where(right < k, self.values[np.minimum(right, k - 1), dims] - part, far)
            nearer = below <= above
            frontier = np.where(nearer, below, above)
            at = np.clip(np.where(nearer, left, right), 0, k - 1)
            left, right = left - nearer, right + ~nearer
            seen = np.zeros((len(going), k), bool)
            seen[np.arange(len(going))[:, None], self.order[at, dims]] = True
            new = seen & ~met[going]
            met[going] |= seen
            for c in np.flatnonzero(new.any(axis=0)):
                rows = np.flatnonzero(new[:, c])
                gap = part[rows] - self.centroids[c]
                distance, rows = (gap * gap).sum(axis=1), going[rows]
                better = (distance < best[rows]) | ((distance == best[rows]) & (c < number[rows]))
                best[rows[better]], number[rows[better]] = distance[better], c
            bound = (frontier * frontier).sum(axis=1)
            on = (bound <= best[going]).astype(bool) & ~met[going].all(axis=1)
            going, left, right = going[on], left[on], right[on]
        return number, best


def _packed(length: int, scale: int, names: list[str]):
    def run(batches):
        for batch in batches:
            good = pa.array(vectors.finite_rows(batch.column(1), length))
            x = vectors.pack(batch.column(1).filter(good), scale, False)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), pa.array(x, pa.binary())], names=names)

    return run


def _pieces(total: int) -> list[tuple[int, int]]:
    """``(place, piece)`` that add up to ``total``."""
    sign, left, out = (1 if total >= 0 else -1), abs(total), []
    while left or not out:
        out.append((len(out), sign * (left & ((1 << _PIECE) - 1))))
        left >>= _PIECE
    return out


def _moments(lists, length: int):
    """Per task and cluster: the number of its vectors (component -1) and the
    sum of each component, in pieces."""

    def run(batches):
        sums: dict[int, list[int]] = {}
        for batch in batches:
            x = vectors.unpack(batch.column(0).to_pylist(), length)
            number, _ = lists.value.nearest(x)
            for c in np.unique(number).tolist():
                own = x[number == c]
                # Sums of halves cannot pass 64 bits.
                if own.dtype == object:
                    new = [int(v) for v in own.sum(axis=0)]
                else:
                    high, low = (own >> 32).sum(axis=0).tolist(), (own & 0xFFFFFFFF).sum(axis=0).tolist()
                    new = [(h << 32) + l for h, l in zip(high, low, strict=True)]
                new = [len(own), *new]
                sums[c] = [a + b for a, b in zip(sums[c], new, strict=True)] if c in sums else new
        if sums:
            cells = [(c, i, *p) for c, row in sums.items() for i, v in enumerate(row, -1) for p in _pieces(v)]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0))
            arrays = [pa.array(v, t) for v, t in zip(zip(*cells, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["cluster", "i", "place", "total"])

    return run


def _assigned(lists, length: int, names: list[str]):
    def run(batches):
        for batch in batches:
            x = vectors.unpack(batch.column(1).to_pylist(), length)
            number, distance = lists.value.nearest(x)
            fitting = [d if d <= _FAR else None for d in distance.tolist()]
            arrays = [batch.column(0), pa.array(number, pa.int32()), pa.array(fitting, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def seeds(kept: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[bytes]:
    """The packed vectors with the smallest hashes of seed and id."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [bytes(r["x"]) for r in kept.select(key.alias("key"), "x").orderBy("key", "x").limit(clusters).collect()]


def centroid_digest(centroid) -> str:
    """sha256 of the components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def cluster(
    table: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    length: int = LENGTH,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``
    of every row with a whole vector."""
    spark = table.sparkSession
    ship(spark)
    kind = table.schema[id].dataType
    rows = table.select(F.col(id).alias("id"), F.col(vector).alias("v"))
    plain = T.StructType([T.StructField("id", kind), T.StructField("x", T.BinaryType())])
    kept = stored(rows.mapInArrow(_packed(length, scale, ["id", "x"]), plain))
    centroids = vectors.unpack(seeds(kept, clusters, seed), length)
    for _ in range(rounds if len(centroids) else 0):
        lists = shared_value(spark, SortedLists(centroids))
        parts = kept.select("x").mapInArrow(_moments(lists, length), "cluster int, i int, place int, total decimal(38,0)")
        found: dict = {}
        for r in parts.groupBy("cluster", "i", "place").agg(F.sum("total").alias("total")).collect():
            own = found.setdefault(r["cluster"], {})
            own[r["i"]] = own.get(r["i"], 0) + (int(r["total"]) << (_PIECE * r["place"]))
        moved = [[total[i] // total[-1] for i in range(length)] if (total := found.get(c)) else row for c, row in enumerate(centroids.tolist())]
        large = any(abs(v) >= 2**62 for row in moved for v in row)
        centroids = np.array(moved, object if large else np.int64).reshape(len(moved), length)
        lists.destroy()
    lists = shared_value(spark, SortedLists(centroids))
    fields = [T.StructField("id", kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    schema = T.StructType(fields)
    done = stored(kept.mapInArrow(_assigned(lists, length, schema.fieldNames()), schema))
    # A distance that is NULL leaves its sums without a value, too.
    whole = F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("total")
    inertia = {r["cluster"]: r["total"] for r in done.groupBy("cluster").agg(whole).collect()}
    total = None if None in inertia.values() else sum(map(int, inertia.values()))
    # One row for each cluster.
    facts = T.StructType([T.StructField("c", T.IntegerType()), T.StructField("own", T.LongType()), T.StructField("sha", T.StringType())])
    numbers = range(len(centroids))
    own = [None if (v := inertia.get(c, 0)) is None or v > _FAR else int(v) for c in numbers]
    known = literal_rows(spark, list(zip(numbers, own, map(centroid_digest, centroids.tolist()), strict=True)), facts)
    return done.join(F.broadcast(known), done["cluster"] == known["c"]).select(
        F.col("id").alias(id),
        "cluster",
        "distance",
        F.col("own").alias("cluster_inertia"),
        F.lit(total if total is not None and total <= _FAR else None).cast("bigint").alias("inertia"),
        F.col("sha").alias("centroid_sha256"),
    )
