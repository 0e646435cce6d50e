"""Whitening and centroid clustering against plain NumPy over whole tables."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tests.llm.rows import SF_DIR
from wickframe.llm import centroids, vectors, whitening
from wickframe.llm.bidiagonal import bidiagonalised, qd_eigenvalues, right_singular
from wickframe.llm.registry import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def table_rows(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    return [(r.vec_id, r.embedding) for r in rows]


def _triangles():
    draw = np.random.default_rng(5)
    turn = np.linalg.qr(draw.standard_normal((24, 24)))[0]
    tall = np.linalg.qr(draw.standard_normal((90, 24)))[0]
    gap = draw.standard_normal((90, 24))
    gap[:, 5] = gap[:, 20:] = 0
    wilkinson = np.diag(np.abs(np.arange(21) - 10.0) + 20) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    return {
        "random": draw.standard_normal((90, 24)),
        "fewer rows than columns": draw.standard_normal((7, 24)),
        "equal values": tall @ np.diag([5.0] * 4 + [3.0] * 10 + [1.0] * 10) @ turn,
        "no variance in some": tall @ np.diag([5.0] * 4 + [3.0] * 10 + [0.0] * 10) @ turn,
        "columns of zeros": gap,
        "columns twice": np.repeat(draw.standard_normal((90, 12)), 2, axis=1),
        "graded": draw.standard_normal((90, 24)) * 10.0 ** np.linspace(0, -8, 24),
        "wilkinson": np.linalg.cholesky(wilkinson).T,
        "identity": np.eye(24),
        "zero": np.zeros((30, 24)),
        "one column": draw.standard_normal((9, 1)),
        "two columns": draw.standard_normal((9, 2)),
    }


@pytest.mark.parametrize("name", list(_triangles()))
def test_singular_values_and_vectors(name):
    rows = _triangles()[name]
    triangle = np.zeros((rows.shape[1], rows.shape[1]))
    upper = np.linalg.qr(rows, mode="r")
    triangle[: len(upper)] = upper
    squares, right = right_singular(triangle)
    expected = np.zeros(len(triangle))
    some = np.linalg.svd(rows, compute_uv=False)
    expected[: len(some)] = some**2
    size = max(1e-300, expected[0])
    assert np.abs(squares - expected).max() <= 1e-13 * size
    assert right.shape[1] == (squares > 0).sum() == np.linalg.matrix_rank(rows, tol=1e-13 * math.sqrt(size))
    assert np.abs(right.T @ right - np.eye(right.shape[1])).max(initial=0) < 1e-9
    assert np.abs(rows.T @ rows @ right - right * squares[: right.shape[1]]).max(initial=0) <= 1e-12 * size


def test_small_singular_values_keep_their_digits():
    """dqds gives each value of a bidiagonal to nearly all its digits, however small it is."""
    diagonal, above = 10.0 ** -np.arange(12.0), 10.0 ** -np.arange(0.5, 11.5)
    from fractions import Fraction

    found = np.sqrt(qd_eigenvalues(diagonal**2, above**2))
    product = math.prod(Fraction(x) for x in diagonal.tolist())
    assert abs(math.prod(Fraction(x) for x in found.tolist()) / product - 1) < Fraction(1, 10**13)


def test_mirrors_keep_the_triangle():
    triangle = np.triu(np.random.default_rng(2).standard_normal((9, 9)))
    diagonal, above, v = bidiagonalised(triangle)
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.allclose(v @ b.T @ b @ v.T, triangle.T @ triangle)


def test_packing_is_the_same_for_equal_rows():
    numbers = np.array([[1, -2], [32767, 0], [32768, 0], [-32768, 0], [1 << 31, 5], [-(1 << 31), 1], [0, 1 << 51]])
    column = vectors.packed(numbers)
    assert [len(row) // 2 for row in column.to_pylist()] == [2, 2, 4, 4, 8, 8, 8]
    assert (vectors.unpacked(column, 2) == numbers).all()


def _plain_whitening(rows, components=16):
    usable = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for _, v in usable], np.int64)
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    whitened = (x - sums / n) @ vectors_[:, :components] / np.sqrt(values[:components])
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return usable, n, deviation, whitened, values[:components] / values.sum()


def test_whitening_of_the_whole_table(spark, table_rows):
    usable, n, deviation, whitened, explained = _plain_whitening(table_rows)
    found = QUERIES["op11_whitening"](spark, SF_DIR)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = {(r.vec_id, r.component): r for r in found.collect()}
    assert len(rows) == 16 * len(usable)
    signs = [math.copysign(1, rows[usable[0][0], c + 1].whitened * whitened[0][c]) for c in range(16)]
    for at, (vec_id, _) in enumerate(usable):
        for c in range(16):
            row = rows[vec_id, c + 1]
            assert (row.n, row.deviation) == (n, deviation[at])
            assert row.whitened == pytest.approx(signs[c] * whitened[at][c], abs=1e-8)
            assert row.explained == pytest.approx(explained[c], rel=1e-10)
            assert 0 <= row.identity_error < 1e-10


def _odd_rows(dimension):
    draw = np.random.default_rng(3)
    plain = [(i, draw.standard_normal(dimension).tolist(), 1) for i in range(60)]
    return [
        *plain,
        *[(100 + i, plain[0][1], 1) for i in range(20)],  # copies
        (3, plain[3][1], 1),  # the same row again
        (3, plain[4][1], 2),  # another vector under its id
        (None, plain[5][1], None),
        (200, None, 1),
        (201, [], 1),
        (202, [None] * dimension, 1),
        (203, [NAN] + [0.0] * (dimension - 1), 1),
        (204, [INF] + [0.0] * (dimension - 1), 1),
        (205, [1.0] * (dimension + 1), 1),
        (206, [3e38] * dimension, 1),
    ]


def test_whitening_of_odd_rows(spark):
    odd = spark.createDataFrame(_odd_rows(6), SCHEMA).withColumnsRenamed({"label": "n"})
    model = whitening.fit(odd)
    assert (model.dimension, model.n, model.directions.shape) == (6, 60, (6, 6))
    assert model.identity_error < 1e-10
    rows = whitening.whiten(odd, model).collect()
    assert len(rows) == 83 * 6
    copies = {round(r.whitened, 9) for r in rows if r.component == 2 and (r.vec_id or 0) in (0, *range(100, 120)) and r.vec_id is not None}
    assert len(copies) == 1
    assert sum(r.vec_id is None for r in rows) == 6


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 1)] * 5, [(1, None, 1)]])
def test_whitening_without_variance_has_no_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert whitening.whiten(df, whitening.fit(df)).collect() == []


def test_directions_without_variance_are_left_out(spark):
    draw = np.random.default_rng(8)
    df = spark.createDataFrame([(i, [float(draw.normal()), 5.0, float(draw.normal())], 1) for i in range(40)], SCHEMA)
    model = whitening.fit(df)
    assert model.directions.shape == (3, 2) and model.explained.sum() == pytest.approx(1)


def test_triangles_are_reduced_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "TOGETHER", 8)
    draw = np.random.default_rng(9)
    rows = [(i, draw.standard_normal(4).tolist(), 1) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    _, _, _, _, explained = _plain_whitening([(i, [float(np.float32(x)) for x in v]) for i, v, _ in rows], 4)
    assert whitening.fit(df).explained == pytest.approx(explained, rel=1e-10)


def test_deviations_beyond_a_bigint_are_null():
    model = whitening.Whitening(1, 64, 0, 10**9, (5 * 10**8,), np.ones((1, 1)), np.ones(1), 0.0)
    centred = model.centred(np.array([[0], [1], [10**6]]))
    assert model.deviations(centred).to_pylist() == [25 * 10**16, 25 * 10**16, None]


def _plain_clusters(rows, clusters=40, rounds=5, dimension=64):
    usable = [(i, v) for i, v in rows if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(256 * c) for c in v] for _, v in usable], np.int64)
    drawn = sorted(range(len(x)), key=lambda at: (hashlib.sha256(f"2:{usable[at][0]}".encode()).hexdigest(), x[at].tolist()))
    c = x[drawn[:clusters]].copy()
    near = lambda: ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    for _ in range(rounds):
        owner = near().argmin(axis=1)
        for k in set(owner.tolist()):
            mine = x[owner == k]
            c[k] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    apart = near()
    owner = apart.argmin(axis=1)
    least = apart.min(axis=1)
    out = []
    for at, (vec_id, _) in enumerate(usable):
        digest = hashlib.sha256(",".join(map(str, c[owner[at]].tolist())).encode()).hexdigest()
        out.append((vec_id, int(owner[at]), int(least[at]), int(least[owner == owner[at]].sum()), int(least.sum()), digest))
    return sorted(out, key=repr)


def test_clusters_of_the_whole_table(spark, table_rows):
    found = QUERIES["op12_centroids"](spark, SF_DIR)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == _plain_clusters(table_rows)


def test_clusters_of_odd_rows(spark):
    rows = [row for row in _odd_rows(64) if row[0] is not None]
    df = spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({"label": "id"})
    expected = _plain_clusters([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v, _ in rows if i != 206])
    assert sorted(map(tuple, centroids.digests(centroids.cluster(df)).collect()), key=repr) == expected


def test_null_ids_are_kept_and_start_last(spark):
    df = spark.createDataFrame([(None, [1.0] * 64, 1), (1, [2.0] * 64, 1)], SCHEMA)
    found = centroids.cluster(df, clusters=1)
    assert found.centroids[0].tolist() == [384] * 64
    assert {r.id for r in found.assigned.collect()} == {None, 1}


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0], 1)]])
def test_no_vectors_no_clusters(spark, rows):
    found = centroids.cluster(spark.createDataFrame(rows, SCHEMA))
    assert found.assigned.collect() == [] and not len(found.centroids)
    assert centroids.digests(found).collect() == []


@pytest.mark.parametrize("kind", ["grid", "far", "copies"])
def test_ties_and_clusters_that_stay_empty(spark, monkeypatch, kind):
    """Whole-number grids full of equal distances, far groups that are measured once, and copies."""
    monkeypatch.setattr(centroids, "BLOCK", 50)
    draw = np.random.default_rng(4)
    if kind == "grid":
        points = draw.integers(-2, 3, (400, 3)) / 256
    elif kind == "far":
        points = draw.normal(0, 0.5, (400, 3)) + 100 * draw.integers(0, 4, (400, 1))
    else:
        points = np.repeat(draw.integers(-2, 3, (4, 3)) / 1.0, 100, axis=0)
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    found = centroids.cluster(df, clusters=7, dimension=3)
    assert sorted(map(tuple, centroids.digests(found).collect()), key=repr) == _plain_clusters(rows, 7, 5, 3)
    assert found.measured[0] == 400
    if kind == "far":
        assert sum(found.measured[1:]) < 4 * 400  # bounds spare measurements


def test_large_numbers_are_exact():
    draw = np.random.default_rng(6)
    points = draw.integers(-centroids.LIMIT + 1, centroids.LIMIT, (20, 64))
    table = centroids._squared(points, points[:5])
    assert all(int(table[i, j]) == sum((int(a) - int(b)) ** 2 for a, b in zip(points[i], points[j])) for i in range(20) for j in range(5))
