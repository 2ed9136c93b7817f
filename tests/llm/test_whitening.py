import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mediabatch.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n long, v string, whitened string"


def table(spark, path, vectors, ids=None):
    rows = [(i, v, 1, 1, 1, "x", "y") for i, v in zip(ids or range(len(vectors)), vectors, strict=True)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


def exact_moments(vectors):
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    v = np.array(
        [[float(Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x), n**3)) for j in range(d)] for i in range(d)]
    )
    return x, sums, v


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12))
def test_inertia_counts_eigenvalues(seed, n):
    rng = np.random.default_rng(seed)
    a = rng.integers(-3, 4, (n, n)).astype(float)
    a = a + a.T
    values = np.linalg.eigvalsh(a)
    for shift in (0.37, -1.21, 2.718, float(values.mean()) + 0.011):
        if np.abs(values - shift).min() > 1e-6:
            assert whitening.inertia(a, shift) == (values > shift).sum()


@pytest.mark.parametrize("kind", ["plain", "clusters", "near", "repeated", "few"])
def test_leading_pairs(kind):
    rng = np.random.default_rng(3)
    n = 40
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    spectrum = {
        "plain": np.sort(rng.exponential(1, n))[::-1],
        "clusters": np.repeat([9.0, 4.0, 4.0 - 1e-7, 1.0], 10),
        "near": 1 + 1e-9 * np.arange(n)[::-1],
        "repeated": np.full(n, 2.5),
        "few": np.concatenate([[7.0, 3.0, 3.0], np.zeros(n - 3)]),
    }[kind]
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.leading(a, 32)
    assert len(values) == (3 if kind == "few" else 32)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][: len(values)], rtol=1e-12, atol=1e-12)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-6
    assert np.abs(vectors @ a - values[:, None] * vectors).max() < 1e-11 * spectrum.max()


def test_query_equals_exact_sums(spark, tmp_path):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((90, 40)) @ rng.standard_normal((40, 40)) * 0.3 + 2
    vectors = [list(map(float, v)) for v in base] + [list(map(float, base[0]))] * 3
    odd = [None, [], [None] * 40, [1.0] * 39 + [float("nan")], [float("inf")] * 40, [1.0] * 7, [1e30] * 40]
    ids = [*range(len(vectors) - 2), None, None, *range(500, 500 + len(odd))]
    got = whitening.whiten(table(spark, tmp_path / "v", vectors + odd, ids)).toPandas()
    x, sums, v = exact_moments(vectors)
    n = len(x)
    assert len(got) == 32 * n and set(got["n"]) == {n}
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:32], axes.T[::-1][:32]
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    for i in range(n - 2):
        own = got[got["vec_id"] == i].sort_values("component")
        assert own["component"].tolist() == list(range(1, 33))
        assert set(own["deviation"]) == {sum((n * a - s) ** 2 for a, s in zip(x[i], sums, strict=True))}
        centred = np.array([float(a - Fraction(s, n)) for a, s in zip(x[i], sums, strict=True)])
        expected = axes @ centred / np.sqrt(values)
        assert np.allclose(np.abs(own["whitened"]), np.abs(expected), rtol=1e-9, atol=1e-9)
        assert np.allclose(own["explained"], values / np.trace(v), rtol=1e-9)
    # One sign for all rows.
    wide = got.dropna().pivot_table(index="vec_id", columns="component", values="whitened").to_numpy()
    centred = np.array([[float(a - Fraction(s, n)) for a, s in zip(r, sums, strict=True)] for r in x[: n - 2]])
    signs = np.sign((wide * (centred @ (axes / np.sqrt(values)[:, None]).T)).sum(axis=0))
    assert np.allclose(wide * signs, centred @ (axes / np.sqrt(values)[:, None]).T, atol=1e-8)


def test_awkward_tables(spark, tmp_path):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for i, vectors in enumerate([[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5]):
        found = whitening.whiten(table(spark, tmp_path / str(i), vectors))
        assert found.columns == columns and found.count() == 0
    line = whitening.whiten(table(spark, tmp_path / "line", [[float(i), float(i)] for i in range(4)])).toPandas()
    assert line["component"].tolist() == [1] * 4 and np.allclose(line["explained"], 1)


def test_large_entries(spark, tmp_path):
    rng = np.random.default_rng(6)
    vectors = [list(map(float, np.float32(v))) for v in rng.standard_normal((30, 3)) * 1e7]
    got = whitening.whiten(table(spark, tmp_path / "v", vectors)).toPandas()
    x, sums, v = exact_moments(vectors)
    assert got["identity_error"][0] < 1e-9
    for i, own in got.groupby("vec_id"):
        exact = sum((30 * a - s) ** 2 for a, s in zip(x[i], sums, strict=True))
        assert set(own["deviation"].isna() if exact >= 2**63 else own["deviation"] == exact) == {True}
    assert np.allclose(sorted(set(got["explained"]))[::-1], np.linalg.eigvalsh(v)[::-1] / np.trace(v), rtol=1e-9)
