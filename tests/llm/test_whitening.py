from fractions import Fraction

import numpy as np
import pytest

from reelmeter.llm import whitening
from reelmeter.llm.whitening import Factors, below, fit, leading, outer, whiten

SCHEMA = "vec_id long, embedding array<float>"


def turned(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    v = q @ np.diag(values) @ q.T
    return (v + v.T) / 2


@pytest.mark.parametrize("seed", range(4))
def test_factors(seed):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(12, 12))
    v = v + v.T
    v[3] = v[:, 3] = 0
    np.fill_diagonal(v[:6, :6], 0)  # pivots of two rows are needed
    for shift in rng.normal(size=50) * 4:
        assert below(v, shift) == (np.linalg.eigvalsh(v) < shift).sum()
    a, b = v + 0.3 * np.eye(12), rng.normal(size=12)
    assert np.allclose(a @ Factors(a).solve(b), b)


@pytest.mark.parametrize(
    "v",
    [
        turned(np.linspace(1, 9, 20)), turned([5, 5, 5, 2, 2, 1, 0, 0]), turned(1 + 1e-10 * np.arange(10)), np.eye(7),
        np.zeros((4, 4)), np.array([[3.0]]), turned(10.0 ** -np.arange(20)), np.ones((9, 9)), turned([1e300, 1e299, 1.0]),
        np.diag([2.0, 2.0, 1.0, 0.0, -0.0]), turned(np.r_[np.ones(30), 2 * np.ones(34)]),
    ],
)
def test_leading(v):
    e, q = leading(v, 32)
    want = np.linalg.eigvalsh(v)[::-1][:32]
    size = max(np.abs(want).max(), 1e-300)
    assert (np.diff(e) <= 0).all() and np.abs(e - want).max() / size < 1e-13
    assert np.abs(q.T @ q - np.eye(len(e))).max() < 1e-12
    assert np.abs(v / size @ q - q * (e / size)).max() < 1e-12
    assert all(c[np.abs(c).argmax()] > 0 for c in q.T)


@pytest.mark.parametrize("size", [3, 1000, 1 << 30, 1 << 44])
def test_outer_is_exact(size):
    z = np.random.default_rng(0).integers(-size, size, (3000 if size < 1 << 20 else 40, 5))
    want = [[sum(int(a) * int(b) for a, b in zip(z[:, i], z[:, j])) for j in range(5)] for i in range(5)]
    assert outer(z).tolist() == want


def plain(rows, components):
    """Everything from exact sums, eigenvectors from numpy."""
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    centred = [[n * r[j] - s[j] for j in range(d)] for r in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(d)] for i in range(d)])
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    w = np.array(centred, float) / n @ q / np.sqrt(e)
    return n, [sum(a * a for a in r) for r in centred], w, e / np.trace(v)


def test_against_plain(spark):
    rng = np.random.default_rng(5)
    spread = np.array([5, 3, 2, 1.5, 1, 0.7, 0.5, 0.3])
    rows = [(i, [float(c) for c in rng.normal(size=8) * spread]) for i in range(400)]
    rows += rows[:3]
    n, deviation, w, explained = plain(rows, 5)
    found = whiten(spark.createDataFrame(rows, SCHEMA).repartition(4), 5).collect()
    assert len(found) == 5 * len(rows) and {r["n"] for r in found} == {n}
    signs = {}
    numbered = {i: k for k, (i, _) in enumerate(rows)}
    for r in found:
        k, c = numbered[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == deviation[k]
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        sign = signs.setdefault(c, 1 if r["whitened"] * w[k, c] > 0 else -1)
        assert r["whitened"] == pytest.approx(sign * w[k, c], abs=1e-8)
        assert r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in found}) == 1


def test_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = [(i, [float(c) for c in rng.normal(size=3)]) for i in range(20)] + [(None, [1.0, 2.0, 3.0])] * 2
    bad = [(30, None), (31, []), (32, [1.0]), (33, [None, 1.0, 1.0]), (34, [float("nan")] * 3), (35, [float("-inf")] * 3), (36, [1e30] * 3)]
    frame = spark.createDataFrame(good + bad, SCHEMA).selectExpr("*", "'x' AS component", "'x' AS n", "'x' AS w", "'x' AS whitened")
    found = whiten(frame).collect()
    assert len(found) == 3 * len(good) and {r["n"] for r in found} == {len(good)}
    assert sorted({str(r["vec_id"]) for r in found}) == sorted({str(i) for i, _ in good})
    assert whiten(frame.where("false")).count() == whiten(frame.where("vec_id = 30")).count() == 0
    assert whiten(frame.where("vec_id = 1")).count() == 0  # nothing varies
    two = whiten(frame.where("vec_id IN (1, 2)")).collect()  # one direction
    assert {r["component"] for r in two} == {1} and sorted(r["whitened"] for r in two) == pytest.approx([-1, 1])


def test_large_entries(spark):
    """Sums and deviations stay exact where doubles and 64 bits do not reach."""
    rows = [(1, [1e11, 5.0]), (2, [-1e11, 7.0]), (3, [0.5, 6.0]), (4, [2.0, 6.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = fit(frame)
    x = [[int(np.floor(64 * c)) for c in v] for _, v in rows]
    assert model.n == 4 and model.sums == [sum(c) for c in zip(*x)]
    found = {(r["vec_id"], r["component"]): r["deviation"] for r in whiten(frame).collect()}
    want = [sum((4 * r[j] - model.sums[j]) ** 2 for j in range(2)) for r in x]
    assert [found[i, 1] for i in range(1, 5)] == [v if v < 1 << 63 else None for v in want]
    assert want[0] >= 1 << 63 > want[2]


def test_dimension(spark):
    rows = [(1, [1.0]), (2, [1.0, 2.0]), (3, [1.0]), (4, [2.0, 3.0]), (5, None), (6, [])]
    assert whitening.dimension(spark.createDataFrame(rows, SCHEMA)) == 2
