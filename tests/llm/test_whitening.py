"""Whitening against plain arithmetic, and slicing against other solvers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from martloom.llm import vectors, whitening
from martloom.llm.queries import QUERIES


def plain(rows, scale=256):
    """Whole-number vectors of rows (id, vector) that count, by the contract."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, [math.floor(float(c) * scale) for c in v]) for i, v in kept]


def check(found, kept, components=4):
    width = max(len(x) for _, x in kept)
    kept = [(i, tuple(x) + (0,) * (width - len(x))) for i, x in kept]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)] for x in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    want = {}
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        y = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)])
        want.setdefault(i, []).append((deviation, y @ axes / np.sqrt(values)))
    assert len(found) == len(kept) * min(components, width)
    sign = {}
    for r in found:
        assert r["n"] == n and r["identity_error"] < 1e-8
        k = r["component"] - 1
        near = [w for d, w in want[r["vec_id"]] if str(d) == r["deviation_text"]]
        assert near and r["deviation"] == (int(r["deviation_text"]) if int(r["deviation_text"]) < 2**63 else None)
        assert r["explained"] == pytest.approx(values[k] / np.trace(centred.T @ centred / n), rel=1e-8)
        w = near[0][k]
        if abs(w) > 1e-6:
            sign.setdefault(k, math.copysign(1, w * r["whitened"]))
        assert r["whitened"] == pytest.approx(sign.get(k, 1) * w, abs=1e-7)


def test_query_against_plain_arithmetic(spark, sf):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(QUERIES["op11_whitening"](spark, sf).collect(), plain(rows))


def table(spark, rows, kind="array<double>"):
    return spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], f"vec_id long, embedding {kind}, n double, x string")


def test_odd_rows_large_offsets_and_copies(spark):
    draw = np.random.default_rng(3)
    rows = [(i, (1e6 + draw.standard_normal(5) * [1, 2, 3, 4, 5]).tolist()) for i in range(60)]
    rows += [(i, rows[0][1]) for i in range(100, 140)] + [(None, rows[1][1]), (None, rows[1][1])]
    odd = [(200, None), (201, [1.0, None, 2.0, 3.0, 4.0]), (202, [math.nan] * 5), (203, [math.inf, 0.0, 0.0, 0.0, 0.0])]
    found = whitening.whiten(table(spark, rows + odd)).collect()
    check(found, plain(rows))


def test_lengths_differ(spark):
    draw = np.random.default_rng(4)
    rows = [(i, draw.standard_normal(3 if i % 2 else 2).tolist()) for i in range(40)] + [(99, []), (98, [0.0, 0.0]), (97, [-0.0])]
    check(whitening.whiten(table(spark, rows)).collect(), plain(rows))


def test_empty_single_and_equal_rows(spark):
    nothing = whitening.whiten(table(spark, [(1, None)]))
    assert nothing.columns[0] == "vec_id" and nothing.collect() == []
    alike = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alike] == [(1, 0, 0.0, 0.0, 1.0)] * 4


def test_deviation_beyond_longs(spark):
    found = whitening.whiten(table(spark, [(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [1e30, 0.0])])).collect()
    kept = [(1, 256 * 10**15, 0), (2, -256 * 10**15, 256), (3, 2**63 - 1, 0)]
    sums = [sum(k[1] for k in kept), 256]
    for i, a, b in kept:
        want = (3 * a - sums[0]) ** 2 + (3 * b - sums[1]) ** 2
        assert {r["deviation_text"] for r in found if r["vec_id"] == i} == {str(want)}
        assert {r["deviation"] for r in found if r["vec_id"] == i} == {None}


@pytest.mark.parametrize("seed", range(6))
def test_counts_and_pairs(seed):
    draw = np.random.default_rng(seed)
    n = int(draw.integers(1, 30))
    a = draw.standard_normal((n, n))
    matrix = a + a.T if seed % 2 else a @ a.T
    values = np.linalg.eigvalsh(matrix)
    for shift in (*draw.uniform(values[0] - 1, values[-1] + 1, 10), values[0] - 1, values[-1] + 1):
        assert whitening.count_above(matrix, shift) == (values > shift).sum()
    found, axes = whitening.leading_pairs(matrix, min(n, 4))
    assert found == pytest.approx(values[::-1][: len(found)], abs=1e-12 * np.abs(values).max())
    assert np.abs(axes.T @ axes - np.eye(len(found))).max() < 1e-12
    assert np.abs(matrix @ axes - axes * found).max() < 1e-12 * np.abs(values).max()


@pytest.mark.parametrize("diagonal", [[1, 1, 1, 1, 1], [3, 3, 3, 1, 1], [5, 5 - 1e-12, 5 - 2e-12, 1, 0], [0, 0, 0, 0, 0]])
def test_eigenvalues_that_meet(diagonal):
    turned, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((5, 5)))
    matrix = turned @ np.diag(np.array(diagonal, float)) @ turned.T
    matrix = (matrix + matrix.T) / 2
    found, axes = whitening.leading_pairs(matrix, 4)
    assert found == pytest.approx(diagonal[:4], abs=1e-12)
    assert np.abs(axes.T @ axes - np.eye(4)).max() < 1e-12
    assert np.abs(matrix @ axes - axes * found).max() < 1e-11


def test_packed_rows_come_back():
    import pyarrow as pa

    rows = [[1.0, -2.0, 0.0], [127.5, -128.0], [-129.0, 3.0], [2.0**31], [-(2.0**62)], [1e30, 0.5], [], [0.0]]
    packed = vectors.pack(pa.array(rows, pa.list_(pa.float64())), 1, False)
    back = vectors.unpack(packed, 3)
    assert [[int(v) for v in r] for r in back.tolist()] == [[math.floor(c) for c in r] + [0] * (3 - len(r)) for r in rows]
