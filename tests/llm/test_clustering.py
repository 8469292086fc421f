"""Clustering against the contract in Python's integers."""

import hashlib
import math

import numpy as np
import pytest

from martloom.llm import clustering
from martloom.llm.queries import QUERIES


def plain(rows, length=64, clusters=8, rounds=10, scale=1024, seed=3):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == length and all(c is not None and math.isfinite(c) for c in v)]
    kept = [(i, [math.floor(float(c) * scale) for c in v]) for i, v in kept]

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    centroids = [x for _, x in sorted(kept, key=lambda r: sha(f"{seed}:{'' if r[0] is None else r[0]}"))[:clusters]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        centroids = [[sum(v) // len(groups[k]) for v in zip(*groups[k], strict=True)] if k in groups else c for k, c in enumerate(centroids)]
    done = [(i, *nearest(x)) for i, x in kept]
    own = {k: sum(d for _, d, c in done if c == k) for k in range(len(centroids))}

    def fits(v):
        return v if v < 2**63 else None

    return [
        (i, k, fits(d), fits(own[k]), fits(sum(own.values())), sha(",".join(map(str, centroids[k])))) for i, d, k in done
    ]


def shown(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_against_plain_version(spark, sf):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert shown(QUERIES["op12_clustering"](spark, sf)) == sorted(plain(rows), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, x string")


def test_odd_rows_ties_and_copies(spark):
    draw = np.random.default_rng(1)
    rows = [(i, (draw.integers(-2, 3, 4) / 1024).tolist()) for i in range(200)] + [(500 + i, [0.001, 0.0, 0.0, 0.0]) for i in range(100)]
    odd = [(900, None), (901, [1.0] * 3), (902, [1.0] * 5), (903, [None, 0.0, 0.0, 0.0]), (904, [math.nan] * 4), (905, [math.inf] * 4), (906, [])]
    want = sorted(plain(rows + odd, 4), key=repr)
    assert shown(clustering.cluster(table(spark, rows + odd), length=4)) == want


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [1.0, 2.0]), (2, [5.0, -1.0]), (3, [1.0, 2.0])]
    assert shown(clustering.cluster(table(spark, rows), length=2)) == sorted(plain(rows, 2), key=repr)
    empty = clustering.cluster(table(spark, [(1, None)]), length=2)
    assert empty.collect() == [] and empty.columns[0] == "vec_id"


def test_numbers_beyond_longs(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 3.0]), (3, [1e9, 2.0]), (4, [1e300, 0.0])]
    assert shown(clustering.cluster(table(spark, rows), length=2, clusters=3)) == sorted(plain(rows, 2, 3), key=repr)


def test_null_ids(spark):
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.0]), (7, [0.0, 4.0])]
    assert shown(clustering.cluster(table(spark, rows), length=2, clusters=1)) == sorted(plain(rows, 2, 1), key=repr)


@pytest.mark.parametrize(("n", "width", "k", "high"), [(300, 64, 8, 600), (300, 3, 8, 3), (100, 2, 5, 2**40), (40, 1, 1, 5), (200, 5, 20, 9)])
def test_walk_finds_the_nearest(n, width, k, high):
    draw = np.random.default_rng(n + k)
    x, centroids = draw.integers(-high, high, (n, width)), draw.integers(-high, high, (k, width))
    number, distance = clustering.SortedLists(centroids).nearest(x)
    for row, c, d in zip(x.tolist(), number, distance, strict=True):
        all_ = [sum((a - b) ** 2 for a, b in zip(row, other, strict=True)) for other in centroids.tolist()]
        assert int(d) == min(all_) and int(c) == all_.index(min(all_))
