"""Spectral divide-and-conquer and whitening against dense algebra and exact sums."""

import math

import numpy as np
import pytest

from specloom.llm import spectral, whitening


@pytest.mark.parametrize("seed", range(6))
def test_components_are_eigenvectors(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(2, 70))
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    e = np.sort([rng.random(n), 10.0 ** -rng.uniform(0, 8, n), np.r_[np.ones(n // 2), rng.random(n - n // 2)]][seed % 3])[::-1]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    values, vectors = spectral.components(a, min(16, n))
    want = np.linalg.eigvalsh(a)[::-1][: len(values)]
    assert len(values) == min(16, n)
    assert np.abs(values - want).max() < 1e-13 * np.abs(want[0]) * n
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * n
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13 * n


def test_special_spectra():
    for a in (np.eye(5), np.zeros((3, 3)), np.diag([1.0, -1.0]), np.diag([3.0, 2.0, 1.0, 2.0]), np.ones((4, 4)), np.array([[2.0]]), np.diag([1.0, 1 + 1e-15, 0.0])):
        values, vectors = spectral.components(a)
        assert np.allclose(values, np.sort(np.linalg.eigvalsh(a))[::-1], atol=1e-13)
        assert np.allclose(vectors.T @ vectors, np.eye(len(a)), atol=1e-13)
        assert np.allclose(a @ vectors, vectors * values, atol=1e-13)


def test_polar_factor():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    e, v = np.linalg.eigh(a)
    assert np.abs(spectral.polar_sign(a) - (v * np.sign(e)) @ v.T).max() < 1e-12


def by_hand(rows, k=16):
    """Contract columns from plain integers and numpy's solver; whitened up to sign."""
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in rows}
    fit = sorted(set(map(tuple, x.values())))
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centre = lambda v: np.array([(n * a - b) / n for a, b in zip(v, s, strict=True)])
    y = np.array([centre(v) for v in fit])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    trace = (y * y).sum() / n
    return {i: (n, sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True)), centre(v) @ u / np.sqrt(e), e / trace) for i, v in x.items()}


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0.0) for i, v in rows], "vec_id long, embedding array<float>, label string, whitened double")


def test_whitening_by_hand(spark):
    rng = np.random.default_rng(2)
    turn = rng.standard_normal((20, 20)) * 10.0 ** -np.linspace(0, 1.5, 20)
    rows = [(i, v) for i, v in enumerate((rng.standard_normal((400, 20)) @ turn.T).astype(np.float32).astype(float).tolist())]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(300)]  # copies weigh once
    odd = [(2000, None), (2001, []), (2002, [float("nan")] * 20), (2003, [None] + [0.0] * 19), (2004, [float("inf")] + [0.0] * 19), (2005, [1e30] + [0.0] * 19)]
    got = {r["vec_id"]: r for r in whitening.whiten(vectors(spark, rows + odd).repartition(4)).collect()}
    want = by_hand(rows)
    assert set(got) == set(want)
    one = next(iter(got.values()))
    sign = np.sign(np.array(one["whitened"]) * want[one["vec_id"]][2])
    for i, (n, deviation, white, explained) in want.items():
        assert (got[i]["n"], got[i]["deviation"]) == (n, deviation)
        assert np.abs(np.array(got[i]["whitened"]) * sign - white).max() < 1e-8
        assert np.abs(np.array(got[i]["explained"]) / explained - 1).max() < 1e-9
        assert got[i]["identity_error"] < 1e-9


def test_lengths_apart_and_flat_lists(spark):
    rng = np.random.default_rng(3)
    short = [(i, v) for i, v in enumerate(rng.standard_normal((50, 3)).astype(np.float32).astype(float).tolist())]
    long = [(100 + i, v) for i, v in enumerate(rng.standard_normal((60, 5)).astype(np.float32).astype(float).tolist())]
    alone = [(500, [1.0, 2.0]), (501, [1.0, 2.0])]  # one distinct vector: nothing varies
    got = {r["vec_id"]: r for r in whitening.whiten(vectors(spark, short + long + alone)).collect()}
    assert set(got) == set(range(50)) | set(range(100, 160))
    for part in (short, long):
        want = by_hand(part)
        for i, (n, deviation, white, _) in want.items():
            assert (got[i]["n"], got[i]["deviation"]) == (n, deviation)
            assert np.abs(np.abs(got[i]["whitened"]) - np.abs(white)).max() < 1e-8
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 5.0, float(2 * i)]) for i in range(9)])).collect()  # one direction varies
    assert all(len(r["whitened"]) == 1 and abs(r["explained"][0] - 1) < 1e-12 for r in flat) and len(flat) == 9
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None)])).count() == 0


def test_deviation_past_a_long():
    model = whitening.Model(10**6, [10**6 * 10**6 + 5, 0], np.zeros((2, 0)), np.zeros(0))
    x = np.array([[10**6 + 10**6, 0], [10**6, 3]])
    assert model.deviations(x) == [(10**12 - 5) ** 2 if (10**12 - 5) ** 2 < 1 << 63 else None, 25 + 9 * 10**12]
