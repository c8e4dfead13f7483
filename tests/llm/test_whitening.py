import math
from fractions import Fraction

import numpy as np
import pytest

from namelens.llm.qdwh import eigen, polar_factor
from namelens.llm.whitening import LONG_MAX, decoded, encoded, fit, grid, grid_points, op13_whitening, whiten

FOLDER = "/root/testdata/sf0.001"


def symmetric(kind, rng):
    x = rng.standard_normal((24, 40))
    return {
        "random": x @ x.T,
        "low rank": x[:, :3] @ x[:, :3].T,
        "graded": np.diag(10.0 ** -np.arange(16)),
        "equal": 3 * np.eye(6),
        "zero": np.zeros((4, 4)),
        "pairs": np.kron(np.eye(6), np.array([[2.0, 1.0], [1.0, 2.0]])),
        "beside the diagonal": np.array([[0.0, 1.0], [1.0, 0.0]]),
        "near equal": np.array([[1.0, 1e-9], [1e-9, 1.0]]),
        "one": np.array([[2.0]]),
    }[kind]


@pytest.mark.parametrize(
    "kind", ["random", "low rank", "graded", "equal", "zero", "pairs", "beside the diagonal", "near equal", "one"]
)
def test_components_like_a_library(kind):
    a = symmetric(kind, np.random.default_rng(5))
    values, vectors = eigen(a)
    scale = max(1.0, np.abs(a).max())
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-13 * scale * len(a))
    assert np.allclose(vectors.T @ vectors, np.eye(len(a)), atol=1e-13)
    assert np.allclose(a @ vectors, vectors * values, atol=1e-13 * scale * len(a))


def test_polar_factor():
    a = symmetric("random", np.random.default_rng(6)) - 30 * np.eye(24)
    values, vectors = np.linalg.eigh(a)
    assert np.allclose(polar_factor(a), (vectors * np.sign(values)) @ vectors.T, atol=1e-13)


def test_points_are_kept_exactly():
    points = np.array([[0, -1], [32767, -32768], [32768, 0], [-32769, 0], [1 << 31, 0], [-(1 << 31), 5], [1 << 46, -(1 << 46)]])
    rows = encoded(points)
    assert decoded(rows, 2).tolist() == points.tolist()
    assert [len(r) for r in rows] == [5, 5, 9, 9, 17, 9, 17]
    assert grid(np.array([[-0.0, 1 / 64, -1e-9, 1e300]])).tolist() == [[0, 1, -1, 1 << 46]]


def brute_force(rows):
    """Contract figures from exact sums; components from a library."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in kept}
    different = sorted(set(map(tuple, x.values())))
    n, size = len(different), len(different[0])
    sums = [sum(v[d] for v in different) for d in range(size)]
    z = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in different])
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, v in x.items():
        far = [n * c - s for c, s in zip(v, sums)]
        white = (np.array([float(Fraction(f, n)) for f in far]) @ vectors) / np.sqrt(values)
        out[i] = (sum(f * f for f in far), white, values / values.sum())
    return n, out


def checked(found, rows):
    n, expected = brute_force(rows)
    by = {}
    for r in found:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(by) == set(expected)
    signs = None
    for i, (deviation, white, share) in sorted(expected.items()):
        own = [by[i][k] for k in sorted(by[i])]
        assert [r["component"] for r in own] == list(range(1, min(16, len(white)) + 1))
        assert {(r["n"], r["deviation"]) for r in own} == {(n, deviation)}
        got = np.array([r["whitened"] for r in own])
        if signs is None:
            signs = np.sign(got * white[: len(got)])
        assert np.allclose(got * signs, white[: len(got)], rtol=1e-7, atol=1e-8)
        assert np.allclose([r["explained"] for r in own], share[: len(got)], rtol=1e-9)
        assert all(r["identity_error"] < 1e-9 for r in own)


def test_query_like_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    checked(op13_whitening(spark, FOLDER).collect(), rows)


def test_repeats_nulls_and_odd_vectors(spark, tmp_path):
    rng = np.random.default_rng(3)
    good = [(i, [float(np.float32(c)) for c in rng.standard_normal(5) + 3]) for i in range(40)]
    # One vector makes up a third of all rows and counts once.
    good += [(100 + i, good[0][1]) for i in range(30)]
    odd = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [math.nan] * 5), (204, [math.inf] * 5), (205, [1.0, 2.0])]
    spark.createDataFrame(good + odd, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    checked(op13_whitening(spark, str(tmp_path)).collect(), good)


def test_columns_of_the_caller(spark):
    ddl = "vec_id int, embedding array<double>, `a.b` string, _row string, point string, whitened int, size int"
    rows = [(1, [1.0, 0.0], "x", "r", "p", 7, 8), (1, [1.0, 0.0], "x", "r", "p", 7, 8), (None, [0.0, 2.0], None, None, None, None, None), (3, [5.0, 2.0], "y", "", "", 0, 0)]
    out, model = whiten(spark.createDataFrame(rows, ddl))
    assert out.columns == ["vec_id", "embedding", "a.b", "_row", "point", "size", "deviation", "whitened"]
    found = out.collect()
    assert len(found) == 4 and model.n == 3
    assert sorted((r["vec_id"] or 0, r["a.b"], r["size"]) for r in found if r["a.b"]) == [(1, "x", 8), (1, "x", 8), (3, "y", 0)]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [2.0, 3.0])], [(1, [2.0, 3.0])] * 3])
def test_nothing_to_whiten(spark, rows):
    out, model = whiten(spark.createDataFrame(rows, "vec_id int, embedding array<double>"))
    assert [len(r["whitened"]) for r in out.collect()] == [0] * (0 if model is None else len(rows))


def test_no_variance_in_a_direction(spark):
    rows = [(i, [float(i), 1.0, float(i * i)]) for i in range(6)]
    out, model = whiten(spark.createDataFrame(rows, "vec_id int, embedding array<double>"))
    assert len(model.values) == 2 and model.identity_error < 1e-9
    assert {len(r["whitened"]) for r in out.collect()} == {2}


def test_far_entries(spark):
    """Differences beyond a long are null, others exact."""
    rows = [(1, [0.0, 1.0]), (2, [1e9, 0.0]), (3, [3e300, 0.0])]
    points = grid_points(spark.createDataFrame(rows, "vec_id int, embedding array<double>"), "embedding", ["vec_id"])
    model = fit(points.select("size", "point"))
    far = model.deviations(np.array([[0, 64], [64 * 10**9, 0], [1 << 46, 0]]))
    exact = [sum((3 * v - s) ** 2 for v, s in zip(p, model.sums)) for p in ([0, 64], [64 * 10**9, 0], [1 << 46, 0])]
    assert far == [v if v <= LONG_MAX else None for v in exact] and None in far
