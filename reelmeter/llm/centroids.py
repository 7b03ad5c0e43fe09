"""Centroid clustering with the equal-average, equal-variance nearest-neighbour search.

Vectors are integers. Centroids are sorted by the mean of their components; the
search for a vector starts at the centroid whose mean is nearest and goes
outwards. With d components, sums s and deviations v (v * v = sum of squared
differences from the own mean), the squared distance of two vectors is at least
(s1 - s2)^2 / d, and at least that plus (v1 - v2)^2. The first bound ends the
scan on a side, the second rejects single centroids; what remains is computed
exactly in integers. Only centroids, counts and sums meet on the driver, and
their number is a parameter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmeter.llm.common import discard, kept_on_disk

#: Vectors that are searched together.
BLOCK = 2_048
#: How much smaller a bound must be than it seems before it counts, since bounds are in doubles.
SAFE = 1 - 1e-9


def largest_component(dim: int) -> int:
    """Components up to this size keep squared distances within 64-bit integers."""
    return math.isqrt((1 << 62) // max(dim, 1)) // 2


class Search:
    """Nearest of ``centroids`` (k x d integers) by scanning outwards in the order of means."""

    def __init__(self, centroids: np.ndarray):
        self.dim = centroids.shape[1]
        self.number = np.argsort(centroids.sum(1), kind="stable")
        self.sorted = np.ascontiguousarray(centroids[self.number])
        self.sums, self.spread = self._features(self.sorted)
        self.computed = 0

    def _features(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = x.sum(1).astype(np.float64)
        centred = x - (sums / self.dim)[:, None]
        return sums, np.sqrt((centred * centred).sum(1))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of every row of ``x``; ties go to the smaller number."""
        n, k = len(x), len(self.number)
        sums, spread = self._features(x)
        up = np.searchsorted(self.sums, sums)  # next centroid to look at on the upper side
        down = up - 1
        best = np.full(n, np.iinfo(np.int64).max)
        which = np.full(n, k, np.int64)
        at = np.arange(n)  # rows that still scan
        while len(at):
            s = sums[at]
            over = np.where(up[at] < k, self.sums[np.minimum(up[at], k - 1)] - s, np.inf)
            under = np.where(down[at] >= 0, s - self.sums[np.maximum(down[at], 0)], np.inf)
            upward = over <= under
            gap = np.where(upward, over, under)
            apart = gap * gap / self.dim
            on = apart * SAFE <= best[at]  # beyond, neither side has anything nearer
            at, upward, apart = at[on], upward[on], apart[on]
            candidate = np.where(upward, up[at], down[at])
            up[at[upward]] += 1
            down[at[~upward]] -= 1
            bound = apart + (spread[at] - self.spread[candidate]) ** 2
            near = bound * SAFE <= best[at]
            rows, c = at[near], candidate[near]
            apart_by = x[rows] - self.sorted[c]
            distance = np.einsum("ij,ij->i", apart_by, apart_by)
            self.computed += len(rows)
            number = self.number[c]
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < which[rows]))
            best[rows[better]] = distance[better]
            which[rows[better]] = number[better]
            at = at[(up[at] < k) | (down[at] >= 0)]
        return which, best


def _integers(batches: Iterator[pa.RecordBatch], dim: int, scale: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The vectors that are kept, as integers: floor(scale * component)."""
    limit = largest_component(dim)
    for batch in batches:
        vectors = batch["embedding"]
        sizes = np.diff(vectors.offsets.to_numpy())
        right = sizes == dim
        if vectors.null_count:
            right &= vectors.is_valid().to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(right)
        chosen = vectors.take(pa.array(rows)) if len(rows) < len(batch) else vectors
        flat = chosen.flatten()
        x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # nulls become NaN
        with np.errstate(invalid="ignore"):
            sound = (np.abs(x) * scale < limit).all(1)
        x = np.floor(x[sound] * scale).astype(np.int64)
        found = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, dim), pa.int32()), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch["vec_id"].take(pa.array(rows[sound])), found], schema=schema)


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _blocks(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    x = _matrix(batch, dim)
    for first in range(0, len(x), BLOCK):
        yield first, x[first : first + BLOCK]


def _totals(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per task and cluster that it meets: count and component sums."""
    search = Search(centroids)
    k, dim = centroids.shape
    counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
    full = (1 << 62) // largest_component(dim)

    def out():
        met = np.flatnonzero(counts)
        columns = [pa.array(met, pa.int32()), pa.array(counts[met])] + [pa.array(sums[met, j]) for j in range(dim)]
        return pa.RecordBatch.from_arrays(columns, ["cluster", "n", *[f"s{j}" for j in range(dim)]])

    for batch in batches:
        for _, x in _blocks(batch, dim):
            if counts.sum() + len(x) > full:  # sums of more rows might not fit
                yield out()
                counts[:] = 0
                sums[:] = 0
            which, _ = search.nearest(x)
            counts += np.bincount(which, minlength=k)
            order = np.argsort(which, kind="stable")
            met, begin = np.unique(which[order], return_index=True)
            sums[met] += np.add.reduceat(x[order], begin, axis=0)
    if counts.any():
        yield out()


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    search = Search(centroids)
    for batch in batches:
        found = [search.nearest(x) for _, x in _blocks(batch, centroids.shape[1])]
        if found:
            which, distance = (np.concatenate(parts) for parts in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(which, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of seed and id; equal ids by components, null ids last."""
    digest = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")).cast("binary"), 256)
    # a top-k: every task keeps k rows
    chosen = vectors.select("x", digest.alias("h")).orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()
    return np.array([r["x"] for r in chosen], np.int64)


def improved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every non-empty centroid becomes the floored mean of its vectors."""
    dim = centroids.shape[1]
    names = [f"s{j}" for j in range(dim)]
    parts = vectors.mapInArrow(
        lambda b: _totals(b, centroids), "cluster int, n long, " + ", ".join(f"{s} long" for s in names)
    )
    # each task sends k rows at most; decimals, since all rows' sums may not fit in 64 bits
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col(s).cast("decimal(20,0)")).alias(s) for s in names])
    out = centroids.copy()
    for row in totals.collect():
        out[row["cluster"]] = [int(row[s]) // row["n"] for s in names]
    return out


def cluster(
    embeddings: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: str = "2:"
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, a row for every vector that is kept.

    Kept are rows of ``embeddings`` (vec_id, embedding) whose vector has exactly ``dim`` components, none
    null, NaN or infinite. A component beyond ``largest_component(dim) / scale`` counts as not finite, since
    distances would leave 64 bits. With fewer than ``k`` vectors each is a centroid. Ties go to
    the smaller centroid number; clusters that no vector is nearest to stay where they are. Repeated rows
    are vectors of their own, a null id is an id (its vector is chosen as a first centroid last). An empty
    table gives an empty one. Other columns are left out. ``inertia`` beyond 64 bits is null.

    Vectors are stored once as integers. A round reads them in their partitions and sends ``k`` sums per task.
    """
    schema = pa.schema([("vec_id", pa.int64()), ("x", pa.list_(pa.int64()))])
    source = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    kept = source.mapInArrow(lambda b: _integers(b, dim, scale, schema), "vec_id long, x array<long>")
    vectors, path = kept_on_disk(kept, "integer-vectors")
    centroids = first_centroids(vectors, k, seed)
    nothing = "vec_id long, cluster int, distance long"
    if not len(centroids):
        found = vectors.select("vec_id").withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long")})
        digests = []
    else:
        for _ in range(rounds):
            centroids = improved(vectors, centroids)
        found, _ = kept_on_disk(vectors.mapInArrow(lambda b: _assigned(b, centroids), nothing), "clusters")
        discard(embeddings.sparkSession, path)
        digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"))
    totals = {r["cluster"]: int(r["d"]) for r in per.collect()}  # k rows at most
    whole = sum(totals.values())
    fits = [totals.get(c, 0) if totals.get(c, 0) < 1 << 63 else None for c in range(len(centroids))]
    return found.select(
        "vec_id", "cluster", "distance",
        F.get(F.lit(None).cast("array<long>") if not fits else F.array(*[F.lit(v).cast("long") for v in fits]), F.col("cluster")).alias("cluster_inertia"),
        F.lit(whole if whole < 1 << 63 else None).cast("long").alias("inertia"),
        F.get(F.lit(None).cast("array<string>") if not digests else F.array(*[F.lit(d) for d in digests]), F.col("cluster")).alias("centroid_sha256"),
    )
