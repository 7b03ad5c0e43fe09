import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelmeter.llm import centroids
from reelmeter.llm.centroids import Search, cluster

SCHEMA = "vec_id long, embedding array<float>"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 12), st.integers(1, 6), st.sampled_from([1, 3, 50, 10**6]), st.integers(0, 10**6))
def test_search_is_exact(n, k, dim, size, seed):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-size, size + 1, (n, dim)), rng.integers(-size, size + 1, (k, dim))
    which, distance = Search(c).nearest(x)
    every = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (which == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_search_at_the_limit():
    m = centroids.largest_component(64)
    x = np.array([[m] * 64, [-m] * 64, [m, -m] * 32])
    which, distance = Search(x[::-1].copy()).nearest(-x)
    every = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, c)) for c in x[::-1]] for r in -x]
    assert distance.tolist() == [min(e) for e in every] and which.tolist() == [e.index(min(e)) for e in every]


def test_search_skips():
    """Vectors far apart in mean or in deviation are rejected without their distance."""
    rng = np.random.default_rng(0)
    c = np.concatenate([rng.integers(0, 10, (20, 16)) + 1000 * i for i in range(20)])
    search = Search(c)
    search.nearest(c)
    assert search.computed < 0.2 * len(c) ** 2
    spread = np.array([[s, -s] * 8 for s in range(0, 4000, 100)])  # all means are zero
    search = Search(spread)
    search.nearest(spread)
    assert search.computed < 0.9 * len(spread) ** 2


def plain(rows, k, rounds, dim, scale, seed):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    c = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, w)), n) for n, w in enumerate(c))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        c = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else w for n, w in enumerate(c)]
    found = [(i, near(v)) for i, v in kept]
    per = {}
    for _, (d, n) in found:
        per[n] = per.get(n, 0) + d
    digest = [hashlib.sha256(",".join(map(str, w)).encode()).hexdigest() for w in c]
    return sorted(str((i, n, d, per[n], sum(per.values()), digest[n])) for i, (d, n) in found)


def got(frame, **options):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(str(tuple(r[c] for c in names)) for r in cluster(frame, **options).collect())


def test_against_plain(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=8) + 3 * (i % 5)]) for i in range(300)]
    options = {"k": 9, "rounds": 4, "dim": 8, "scale": 16, "seed": "2:"}
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5), **options) == plain(rows, **options)


def test_odd_rows(spark):
    base = [float(x) for x in range(4)]
    rows = [(i, [b + i for b in base]) for i in range(6)] + [(1, [9.0, 9.0, 9.0, 9.0])] * 3 + [(None, [0.5] * 4), (None, [0.5] * 4)]
    bad = [(7, None), (8, []), (9, base[:3]), (10, [*base, 1.0]), (11, [None, 1.0, 2.0, 3.0]), (12, [float("nan")] * 4), (13, [float("inf"), 1.0, 1.0, 1.0]), (14, [3e38] * 4)]
    frame = spark.createDataFrame(rows + bad, SCHEMA).selectExpr("*", "'x' AS cluster", "'x' AS distance", "'x' AS x", "'x' AS inertia")
    for k in (3, 40):
        options = {"k": k, "rounds": 2, "dim": 4, "scale": 8, "seed": "2:"}
        assert got(frame, **options) == plain(rows, **options)
    assert cluster(frame.where("false")).count() == 0
    assert cluster(frame.where("embedding IS NULL")).count() == 0


def test_ties_and_empty_clusters(spark):
    """Equal vectors fill equal centroids: the smallest number takes all, the others stay."""
    rows = [(i, [1.0, 1.0]) for i in range(20)] + [(100, [3.0, 1.0])]
    options = {"k": 4, "rounds": 3, "dim": 2, "scale": 1, "seed": "2:"}
    found = cluster(spark.createDataFrame(rows, SCHEMA), **options)
    assert got(spark.createDataFrame(rows, SCHEMA), **options) == plain(rows, **options)
    assert found.select("cluster").distinct().count() <= 2


@pytest.mark.parametrize("rows", [1, 3])
def test_sums_flushed(monkeypatch, rows):
    """Sums that might leave 64 bits are handed on in parts."""
    import pyarrow as pa

    monkeypatch.setattr(centroids, "largest_component", lambda dim: (1 << 62) // rows)
    batch = pa.RecordBatch.from_pydict({"x": pa.array([[i, 2 * i] for i in range(7)], pa.list_(pa.int64()))})
    parts = list(centroids._totals(iter([batch, batch]), np.array([[0, 0], [5, 9]])))
    assert sum(sum(p["n"].to_pylist()) for p in parts) == 14
    assert sum(sum(p["s1"].to_pylist()) for p in parts) == 2 * 42
