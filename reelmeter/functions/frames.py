"""Row-level pixel rules on numpy arrays, wrapped as Arrow-batched column functions.

A pixel cell is ``binary`` (8-bit, row-major) or an array of ints. Spark
decides which frames meet in which task; these helpers only look at one frame
(or one pair of frames) at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmeter.fixed_values import (
    BRIGHT_RATIO,
    DARKNESS,
    DEFAULT_BOTTOM,
    DEFAULT_TOP,
    SCAN_END,
    SCAN_START,
    SCAN_STEP,
)
from reelmeter.functions.arithmetic import evaluated_once
from reelmeter.functions.vectors import as_bytes


def to_gray(pixels: Column, channels: Column) -> Column:
    """Luma bytes of interleaved colour bytes; ``channels`` is RGB or BGR, or GRAY.

    Integer BT.601 rule: ``(4899 R + 9617 G + 1868 B + 8192) >> 14``.
    """

    @F.pandas_udf(T.BinaryType())
    def luma(cells: pd.Series, orders: pd.Series) -> pd.Series:
        def one(cell, order: str) -> bytes:
            flat = as_bytes(cell)
            if order == "GRAY":
                return flat.tobytes()
            colours = flat.reshape(-1, 3).astype(np.int64)
            r, g, b = (colours[:, order.index(c)] for c in "RGB")
            return ((4899 * r + 9617 * g + 1868 * b + 8192) >> 14).astype(np.uint8).tobytes()

        return pd.Series([one(c, o) for c, o in zip(cells, orders)], dtype=object)

    return evaluated_once(luma)(pixels, channels)


def bright_share(gray: Column, height: Column, width: Column, darkness: int = DARKNESS) -> Column:
    """Share of pixels at or above ``darkness`` in each row, top to bottom.

    The one look at the pixels that all black-bar rules need; what follows is
    arithmetic on at most ``height`` numbers.
    """

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def count(cells: pd.Series, heights: pd.Series, widths: pd.Series) -> pd.Series:
        return pd.Series(
            [
                (as_bytes(c).reshape(int(h), int(w)) >= darkness).sum(axis=1).astype(np.int32)
                for c, h, w in zip(cells, heights, widths)
            ],
            dtype=object,
        )

    return evaluated_once(count)(gray, height, width)


def region_rows(height: Column, percent: Column | float) -> Column:
    percent = percent if isinstance(percent, Column) else F.lit(float(percent))
    return (height * percent / 100).cast("int")


def black_region(
    bright: Column, height: Column, width: Column, position: str, percent: float,
    black_ratio: float,
) -> Column:
    """Whether at least ``black_ratio`` of the top or bottom region is dark."""
    rows = region_rows(height, percent)
    start = F.lit(1) if position == "top" else height - rows + 1
    bright_pixels = F.aggregate(F.slice(bright, start, rows), F.lit(0), lambda a, x: a + x)
    dark = F.try_divide((rows * width - bright_pixels).cast("double"), (rows * width).cast("double"))
    return F.coalesce(dark >= black_ratio, F.lit(False))


def crop_boundary(
    bright: Column,
    height: Column,
    width: Column,
    position: str,
    bright_ratio: float = BRIGHT_RATIO,
    scan: tuple[float, float, float] = (SCAN_START, SCAN_END, SCAN_STEP),
) -> Column:
    """First mostly bright row met while scanning inward, or the default cut.

    Candidate rows outside the frame (tiny frames) are skipped.
    """
    first, last, step = scan
    percents = F.array(*[F.lit(first + i * step) for i in range(int((last - first) / step) + 1)])

    def row(percent: Column) -> Column:
        rows = region_rows(height, percent)
        return (height - rows) if position == "bottom" else (rows - 1)

    def is_bright(r: Column) -> Column:
        share = F.get(bright, r).cast("double") / width.cast("double")
        return (r >= 0) & (r < height) & (share >= bright_ratio)

    found = F.get(F.filter(F.transform(percents, row), is_bright), F.lit(0))
    default = (
        height - (height * DEFAULT_BOTTOM).cast("int")
        if position == "bottom"
        else (height * DEFAULT_TOP).cast("int")
    )
    return F.coalesce(found, default)


_SUMS = ("xx", "xy", "yy", "xt", "yt")


def gradient_sums(previous: Column, current: Column, height: Column, width: Column, block: int) -> Column:
    """Per block, the sums of gradient products of a pair of gray frames.

    Central differences of the previous frame and the difference in time, over
    interior pixels; blocks are ``block`` pixels square, in order row by row.
    A struct of five arrays, one number per block each.
    """

    @F.pandas_udf(T.StructType([T.StructField(name, T.ArrayType(T.DoubleType())) for name in _SUMS]))
    def sums(before: pd.Series, after: pd.Series, heights: pd.Series, widths: pd.Series) -> pd.DataFrame:
        def one(p, c, h: int, w: int) -> list[np.ndarray]:
            a = as_bytes(p).reshape(h, w).astype(np.float64)
            b = as_bytes(c).reshape(h, w).astype(np.float64)
            ix = (a[1:-1, 2:] - a[1:-1, :-2]) / 2
            iy = (a[2:, 1:-1] - a[:-2, 1:-1]) / 2
            it = (b - a)[1:-1, 1:-1]
            rows, cols = np.arange(1, h - 1) // block, np.arange(1, w - 1) // block
            down, across = -(-h // block), -(-w // block)
            ids = (rows[:, None] * across + cols[None, :]).ravel()
            products = (ix * ix, ix * iy, iy * iy, ix * it, iy * it)
            return [np.bincount(ids, weights=x.ravel(), minlength=down * across) for x in products]

        totals = [one(p, c, int(h), int(w)) for p, c, h, w in zip(before, after, heights, widths)]
        return pd.DataFrame(
            {name: pd.Series([t[i] for t in totals], dtype=object) for i, name in enumerate(_SUMS)}
        )

    return evaluated_once(sums)(previous, current, height, width)


def area_weights(source: int, target: int) -> np.ndarray:
    """``target x source`` matrix averaging by overlapped length."""
    edges = np.linspace(0.0, source, target + 1)
    cells = np.arange(source)
    overlap = np.minimum(edges[1:, None], cells + 1.0) - np.maximum(edges[:-1, None], cells)
    return np.clip(overlap, 0.0, None) * (target / source)


def downscale(values: Column, height: Column, width: Column, target_width: int) -> Column:
    """Area average of a flat map to ``target_width``, keeping its shape."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def shrink(maps: pd.Series, heights: pd.Series, widths: pd.Series) -> pd.Series:
        def one(flat: Sequence[float], h: int, w: int) -> np.ndarray:
            grid = np.asarray(flat, dtype=np.float64).reshape(h, w)
            out_h = int(h * (target_width / w))
            small = area_weights(h, out_h) @ grid @ area_weights(w, target_width).T
            return small.astype(np.float32).ravel()

        return pd.Series(
            [one(m, int(h), int(w)) for m, h, w in zip(maps, heights, widths)], dtype=object
        )

    return evaluated_once(shrink)(values, height, width)
