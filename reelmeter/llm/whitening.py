"""Whitening of embeddings, with eigenvalues found by spectrum slicing.

The covariance is summed up exactly in integers, in the partitions, so only
d x d numbers reach the driver. There, the inertia of V - sI, read off the
pivots of an LDL^T factorisation, counts the eigenvalues below a shift s.
Halving shifts isolate each leading eigenvalue, Rayleigh quotient iteration
from inside its interval converges cubically, and counts on both sides of the
result certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this size count as not finite: integers above it are not exact in doubles.
LARGEST = float(1 << 45)
#: Rows that are multiplied at a time.
ROWS = 1_024
_GROWTH = (1 + 17**0.5) / 8


# ---- symmetric matrices on the driver, of a size that the dimension sets ----------------


class Factors:
    """P A P^T = L D L^T of a symmetric matrix, with 1 x 1 and 2 x 2 pivots chosen for stability."""

    def __init__(self, a: np.ndarray):
        a = a.copy()
        n = len(a)
        self.order, self.lower, self.pivots = np.arange(n), np.eye(n), []
        tiny = max(np.finfo(float).eps * float(np.abs(a).max()), np.finfo(float).tiny / np.finfo(float).eps)
        k = 0
        while k < n:
            size, other = 1, k
            if k + 1 < n:
                column = np.abs(a[k + 1 :, k])
                r = int(column.argmax()) + k + 1
                off = column[r - k - 1]
                if off > 0 and abs(a[k, k]) < _GROWTH * off:
                    row = np.abs(a[r, k:])
                    row[r - k] = 0
                    sigma = row.max()
                    if abs(a[k, k]) * sigma >= _GROWTH * off * off:
                        pass
                    elif abs(a[r, r]) >= _GROWTH * sigma:
                        other = r
                    else:
                        size, other = 2, r
            self._swap(a, k + size - 1, other, k)
            end = k + size
            block = a[k:end, k:end].copy()
            if size == 1 and abs(block[0, 0]) < tiny:
                block[0, 0] = -tiny  # an eigenvalue at the shift itself counts as below
            self.pivots.append(block)
            if end < n:
                left = np.linalg.solve(block, a[k:end, end:]).T
                a[end:, end:] -= left @ a[k:end, end:]
                a[end:, end:] = (a[end:, end:] + a[end:, end:].T) / 2
                self.lower[end:, k:end] = left
            k = end

    def _swap(self, a: np.ndarray, i: int, j: int, done: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            self.lower[[i, j], :done] = self.lower[[j, i], :done]
            self.order[[i, j]] = self.order[[j, i]]

    def negative(self) -> int:
        """Negative eigenvalues, which are as many as D has (Sylvester)."""
        return sum(int(p[0, 0] < 0) if len(p) == 1 else 1 for p in self.pivots)

    def solve(self, b: np.ndarray) -> np.ndarray:
        y = b[self.order].copy()
        n = len(y)
        for k in range(n):
            y[k + 1 :] -= self.lower[k + 1 :, k] * y[k]
        k = 0
        for p in self.pivots:
            y[k : k + len(p)] = np.linalg.solve(p, y[k : k + len(p)])
            k += len(p)
        for k in reversed(range(n)):
            y[k] -= self.lower[k + 1 :, k] @ y[k + 1 :]
        out = np.empty(n)
        out[self.order] = y
        return out


def below(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``v`` below ``shift``."""
    return Factors(v - shift * np.eye(len(v))).negative()


def leading(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Every vector is kept at right angles to those before it, so eigenvalues that agree to
    rounding, which counts cannot tell apart, get different vectors. Of a vector's two signs, the
    one whose largest entry is positive is taken.
    """
    d = len(v)
    count = min(count, d)
    scale = float(np.abs(v).sum(1).max())
    values, vectors = np.zeros(count), np.zeros((d, count))
    if scale == 0:
        vectors[:count] = np.eye(count)
        return values, vectors
    eps = 4 * d * np.finfo(float).eps * scale
    counted: dict[float, int] = {-2 * scale: 0, 2 * scale: d}

    def count_below(shift: float) -> int:
        if shift not in counted:
            counted[shift] = below(v, shift)
        return counted[shift]

    def interval(number: int) -> tuple[float, float]:
        """The narrowest known one that holds eigenvalue ``number`` (counted from below)."""
        return max(s for s, c in counted.items() if c <= number), min(s for s, c in counted.items() if c > number)

    def refined(number: int, width: float) -> tuple[float, float]:
        low, high = interval(number)
        while high - low > width:
            count_below((low + high) / 2)
            low, high = interval(number)
        return low, high

    def isolated(number: int) -> tuple[float, float]:
        low, high = interval(number)
        while counted[high] - counted[low] > 1 and high - low > eps:
            count_below((low + high) / 2)
            low, high = interval(number)
        return low, high

    rng = np.random.default_rng(0)  # start vectors only: results do not depend on them beyond rounding
    for i in range(count):
        number = d - 1 - i
        low, high = isolated(number)
        while True:
            value, x = _rayleigh(v, (low + high) / 2, vectors[:, :i], low - eps, high + eps, rng)
            certain = value is not None and count_below(value - eps) <= number < count_below(value + eps)
            if certain:
                break
            if high - low <= eps:  # as narrow as doubles allow: its middle is the eigenvalue
                value, x = _inverse(v, (low + high) / 2, vectors[:, :i], rng)
                break
            low, high = refined(number, (high - low) / 8)
        values[i], vectors[:, i] = value, x if x[np.abs(x).argmax()] > 0 else -x
    order = np.argsort(-values, kind="stable")  # within a group that counts do not part
    return values[order], vectors[:, order]


def _apart(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max()
    for _ in range(2):
        x = x - others @ (others.T @ x)
    return x / np.linalg.norm(x)


def _inverse(v, shift, others, rng):
    f = Factors(v - shift * np.eye(len(v)))
    x = _apart(rng.normal(size=len(v)), others)
    for _ in range(6):
        x = _apart(f.solve(x), others)
    return float(x @ v @ x), x


def _rayleigh(v, shift, others, low, high, rng):
    """Inverse iteration from the middle of the interval, then Rayleigh quotients; none when it leaves the interval."""
    _, x = _inverse(v, shift, others, rng)
    value = float(x @ v @ x)
    scale = float(np.abs(v).sum(1).max())
    residual = np.inf
    for _ in range(12):
        if not low <= value <= high:
            return None, x
        y = Factors(v - value * np.eye(len(v))).solve(x)
        if not np.isfinite(y).all() or not np.any(y):
            break
        x = _apart(y, others)
        value = float(x @ v @ x)
        now = float(np.linalg.norm(v @ x - value * x))
        if now <= 2 * np.finfo(float).eps * scale or now >= residual / 2:
            break
        residual = now
    return (value, x) if low <= value <= high else (None, x)


# ---- vectors in their partitions --------------------------------------------------------


def _rows(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, integers without the shift) of the vectors that remain."""
    vectors = batch["embedding"]
    right = np.diff(vectors.offsets.to_numpy()) == dim
    if vectors.null_count:
        right &= vectors.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(right)
    chosen = vectors.take(pa.array(rows)) if len(rows) < len(batch) else vectors
    x = chosen.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    with np.errstate(invalid="ignore"):
        sound = (np.abs(x) * SCALE < LARGEST).all(1)
    return rows[sound], np.floor(x[sound] * SCALE).astype(np.int64)


def _sums(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Per task: (j, sum of component j), and the number of rows as j = -1."""
    n, total = 0, np.zeros(dim, object)
    for batch in batches:
        _, x = _rows(batch, dim)
        n += len(x)
        total += x.sum(0).astype(object)  # a batch of 46-bit numbers fits in 64 bits
    if n:
        yield pa.RecordBatch.from_pydict(
            {
                "j": pa.array(range(-1, dim), pa.int32()),
                "total": pa.array([str(v) for v in [n, *total]], pa.string()),
            }
        )


def outer(z: np.ndarray) -> np.ndarray:
    """Sum of z z^T over the rows, exactly, as Python integers."""
    dim = z.shape[1]
    total = np.zeros((dim, dim), object)
    largest = int(np.abs(z).max(initial=0))
    if largest * largest * min(len(z), ROWS) < 1 << 53:
        whole = np.zeros((dim, dim), np.int64)
        for first in range(0, len(z), ROWS):
            part = z[first : first + ROWS].astype(np.float64)
            whole += (part.T @ part).astype(np.int64)  # every partial sum is an integer below 2**53
        return total + whole
    big = z.astype(object)
    for row in big:
        total += np.multiply.outer(row, row)
    return total


def _products(batches: Iterator[pa.RecordBatch], dim: int, middle: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per task: (cell, sum over rows) of the upper half of the products of centred components."""
    total, seen = np.zeros((dim, dim), object), False
    for batch in batches:
        _, x = _rows(batch, dim)
        if len(x):
            total += outer(x - middle)
            seen = True
    if seen:
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_pydict(
            {"cell": pa.array(i * dim + j, pa.int32()), "total": pa.array([str(v) for v in total[i, j]], pa.string())}
        )


def _moments(batches, dim: int, model: Whitening) -> Iterator[pa.RecordBatch]:
    """Per task: sums of the whitened values and of their products."""
    m = model.vectors.shape[1]
    first, second, n = np.zeros(m), np.zeros((m, m)), 0
    for batch in batches:
        _, x = _rows(batch, dim)
        w = model.apply(x)
        first += w.sum(0)
        second += w.T @ w
        n += len(w)
    if n:
        flat = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(flat)), pa.int32()), "total": pa.array(flat)})


def _whitened(batches, dim: int, model: Whitening) -> Iterator[pa.RecordBatch]:
    m = model.vectors.shape[1]
    for batch in batches:
        rows, x = _rows(batch, dim)
        w = model.apply(x)
        offsets = pa.array(np.arange(0, w.size + 1, m) if len(x) else np.zeros(1, int), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch["vec_id"].take(pa.array(rows)),
                pa.array(model.deviations(x), pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(w.ravel())),
            ],
            ["vec_id", "deviation", "w"],
        )


@dataclass
class Whitening:
    """What the fit gives: rows, sums (without the shift), eigenvalues, eigenvectors as columns, trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def __post_init__(self):
        self.middle = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = [s % self.n for s in self.sums]  # n times the fraction of the mean
        self.fraction = np.array([r / self.n for r in self.rest])

    def apply(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.middle) - self.fraction) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None] | np.ndarray:
        """Sum of (n x - S)^2 per row, exactly; None where 64 bits do not hold it."""
        z = x - self.middle  # n x - S = n z - rest
        n = self.n
        reach = n * (int(np.abs(z).max(initial=0)) + 1)
        if reach * reach * len(self.rest) < 1 << 63:
            apart = n * z - np.array(self.rest, np.int64)
            return (apart * apart).sum(1)
        rows = [sum((n * a - r) ** 2 for a, r in zip(row, self.rest)) for row in z.tolist()]
        return [v if v < 1 << 63 else None for v in rows]


def _prepared(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )


def dimension(embeddings: DataFrame) -> int:
    """The length that most non-null vectors have, the larger one in a tie; 0 without any."""
    sizes = embeddings.where("embedding IS NOT NULL").groupBy(F.size("embedding").alias("d")).count()
    row = sizes.where("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    return row["d"] if row else 0


def _exact(parts: DataFrame, key: str) -> dict[int, int]:
    """Sums of whole numbers that tasks sent as text, combined in decimals where they fit."""
    total = parts.groupBy(key).agg(
        F.sum(F.expr("try_cast(total AS decimal(38,0))")).alias("t"), F.count(F.lit(1)).alias("n"),
        F.count(F.expr("try_cast(total AS decimal(38,0))")).alias("fit"),
    )
    found = {}
    for r in total.collect():
        if r["n"] != r["fit"] or r["t"] is None:
            raise OverflowError("sums of 38 digits and more")
        found[r[key]] = int(r["t"])
    return found


def fit(embeddings: DataFrame, components: int = 32, dim: int | None = None) -> Whitening | None:
    """Mean, covariance and leading eigenpairs; None without a vector that remains.

    Directions in which the vectors do not vary (a rank below ``components``) are no components.
    """
    rows = _prepared(embeddings)
    dim = dim or dimension(rows)
    if not dim:
        return None
    sums = _exact(rows.mapInArrow(lambda b: _sums(b, dim), "j int, total string"), "j")
    n = sums.pop(-1, 0)
    if not n:
        return None
    s = [sums[j] for j in range(dim)]
    middle = np.array([x // n for x in s], np.int64)
    cells = _exact(rows.mapInArrow(lambda b: _products(b, dim, middle), "cell int, total string"), "cell")
    rest = [x % n for x in s]
    v = np.zeros((dim, dim))
    for cell, total in cells.items():
        i, j = divmod(cell, dim)
        v[i, j] = v[j, i] = float(Fraction(n * total - rest[i] * rest[j], n * n))  # rounded once
    values, vectors = leading(v, components)
    varies = values > dim * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
    return Whitening(n, s, values[varies], vectors[:, varies], float(np.trace(v)))


def identity_error(embeddings: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the covariance of the whitened rows minus the identity, measured over all rows."""
    rows, dim, m = _prepared(embeddings), len(model.sums), len(model.values)
    parts = rows.mapInArrow(lambda b: _moments(b, dim, model), "cell int, total double")
    total = {r["cell"]: r["t"] for r in parts.groupBy("cell").agg(F.sum("total").alias("t")).collect()}
    flat = np.array([total[i] for i in range(m + m * m)]) / model.n
    mean = flat[:m]
    return float(np.abs(flat[m:].reshape(m, m) - np.outer(mean, mean) - np.eye(m)).max())


def whiten(embeddings: DataFrame, components: int = 32, dim: int | None = None) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component.

    Left out are rows of ``embeddings`` (vec_id, embedding) whose vector is null or holds a null, NaN
    or infinite entry, whose length is not ``dim`` (the most frequent length unless given), or with an entry
    beyond ``LARGEST / SCALE``. Entries become x = floor(64 c) + 1000000. All remaining rows are
    fitted; repeated rows count as often as they occur and give repeated results, a null id is kept. An empty
    table, or equal vectors only (nothing varies), give no rows. ``deviation`` is null where 64 bits do not
    hold it. Other columns are left out.

    Four passes over the vectors (sums, products, check, result), none with a shuffle of vectors: a task sends
    d, d (d + 1) / 2 and 33 * 32 numbers.
    """
    spark = embeddings.sparkSession
    model = fit(embeddings, components, dim)
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return spark.createDataFrame([], out)
    error = identity_error(embeddings, model)
    size = len(model.sums)
    rows = _prepared(embeddings).mapInArrow(lambda b: _whitened(b, size, model), "vec_id long, deviation long, w array<double>")
    explained = F.array(*[F.lit(float(e) / model.trace) for e in model.values])
    return rows.select("vec_id", "deviation", F.posexplode("w").alias("c", "whitened")).select(
        "vec_id", (F.col("c") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("c")).alias("explained"), F.lit(error).alias("identity_error"),
    )
