"""Motion between consecutive frames of a clip."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmeter.functions.arithmetic import whole
from reelmeter.functions.frames import downscale, gradient_sums
from reelmeter.functions.vectors import as_bytes
from reelmeter.operators.ordering import attach

PAIR_SEGMENT = 256


def frame_pairs(
    frames: DataFrame,
    payload: Sequence[str] = ("gray",),
    index: str = "sample_no",
    keep: Sequence[str] = (),
    segment: int = PAIR_SEGMENT,
) -> DataFrame:
    """Each frame with the one before it; n frames give n-1 pairs.

    ``index`` orders a clip's frames; numbers may be missing. Clips are cut
    into segments of fixed length and the last frame that a segment has is
    also sent to the next segment that has any, so the payload is shuffled
    once and no task holds more of it than a segment of a clip, however long
    the clip is. Which frames are last is found before from numbers alone: a
    row per segment, so ``frames`` is evaluated twice, the first time without
    payload. Shrink the payload (gray, small) before.
    """
    seg = whole(index, segment)
    ends = frames.groupBy("clip_id", seg.alias("_seg")).agg(F.max(index).alias("_end"))
    following = F.lead("_seg").over(Window.partitionBy("clip_id").orderBy("_seg"))
    tails = ends.select(
        F.struct("clip_id", F.col("_end").alias(index)).alias("_frame"), following.alias("_next")
    ).where(F.col("_next").isNotNull())
    keyed = frames.select("clip_id", index, *keep, *payload, F.struct("clip_id", index).alias("_frame"))
    rows = attach(keyed, tails, "_frame", F.col(index), how="left").select(
        "clip_id",
        index,
        *keep,
        *payload,
        F.explode(
            F.when(F.col("_next").isNotNull(), F.array(seg, "_next")).otherwise(F.array(seg))
        ).alias("_seg"),
    )
    w = Window.partitionBy("clip_id", "_seg").orderBy(index)
    before = F.lag(F.struct(F.col(index).alias("at"), *payload)).over(w)
    pairs = rows.withColumn("_before", before).where(F.col("_before").isNotNull() & (F.col("_seg") == seg))
    return pairs.select(
        "clip_id",
        F.col("_before.at").alias("pair_no"),
        *keep,
        *[F.col(f"_before.{c}").alias(f"prev_{c}") for c in payload],
        *payload,
    )


def flow_maps(pairs: DataFrame, block: int = 8) -> DataFrame:
    """Flow map of each pair: displacement (u, v) per block by least squares.

    Solves the 2x2 normal equations of the gradient constraint; a block
    without texture in two directions gets (0, 0). A narrow step: each pair's
    map is made where the pair is.
    """
    height, width = F.col("height"), F.col("width")
    sums = gradient_sums(F.col("prev_gray"), F.col("gray"), height, width, block)
    blocks = F.arrays_zip(*[f"_g.{name}" for name in ("xx", "xy", "yy", "xt", "yt")])

    def solve(numerator: Callable[[Column], Column]) -> Column:
        def one(s: Column) -> Column:
            det = s["xx"] * s["yy"] - s["xy"] * s["xy"]
            return F.coalesce(F.try_divide(numerator(s), det), F.lit(0.0))

        return F.transform(blocks, one)

    return pairs.withColumn("_g", sums).select(
        "clip_id",
        "pair_no",
        F.ceil(height / block).cast("int").alias("height"),
        F.ceil(width / block).cast("int").alias("width"),
        solve(lambda s: s["xy"] * s["yt"] - s["yy"] * s["xt"]).alias("u"),
        solve(lambda s: s["xy"] * s["xt"] - s["xx"] * s["yt"]).alias("v"),
    )


def block_flow(pairs: DataFrame, block: int = 8) -> DataFrame:
    """The flow maps as a row per block."""
    return (
        flow_maps(pairs, block)
        .select("clip_id", "pair_no", F.posexplode(F.arrays_zip("u", "v")).alias("block", "_f"))
        .select("clip_id", "pair_no", "block", "_f.u", "_f.v")
    )


def dense_flow(
    pairs: DataFrame, flow_fn: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
) -> DataFrame:
    """Flow maps by a plug-in solver ``flow_fn(previous, current) -> (u, v)``."""

    def solve(batches):
        for pdf in batches:
            flows = [
                flow_fn(as_bytes(p).reshape(h, w), as_bytes(c).reshape(h, w))
                for p, c, h, w in zip(pdf.prev_gray, pdf.gray, pdf.height, pdf.width)
            ]
            out = pdf[["clip_id", "pair_no", "height", "width"]].copy()
            for i, name in enumerate(("u", "v")):
                out[name] = pd.Series(
                    [np.asarray(f[i], np.float32).ravel() for f in flows], dtype=object, index=out.index
                )
            yield out

    clip_type = pairs.schema["clip_id"].dataType.simpleString()
    pair_type = pairs.schema["pair_no"].dataType.simpleString()
    return pairs.select("clip_id", "pair_no", "height", "width", "prev_gray", "gray").mapInPandas(
        solve,
        f"clip_id {clip_type}, pair_no {pair_type}, height int, width int, u array<float>, v array<float>",
    )


def flow_polar(flows: DataFrame) -> DataFrame:
    """Magnitude and angle (0 to 2 pi) of each flow vector."""

    def angle(p: Column) -> Column:
        a = F.atan2(p["v"], p["u"])
        return F.when(a < 0, a + 2 * np.pi).otherwise(a)

    vectors = F.arrays_zip("u", "v")
    return flows.withColumns(
        {
            "magnitude": F.transform(vectors, lambda p: F.hypot(p["u"], p["v"])),
            "angle": F.transform(vectors, angle),
        }
    )


def downscale_flow(flows: DataFrame, width: int = 16) -> DataFrame:
    """Flow maps averaged by area to a width of 16 and the height that follows."""
    h, w = F.col("height"), F.col("width")
    return flows.withColumns(
        {
            "u": downscale(F.col("u"), h, w, width),
            "v": downscale(F.col("v"), h, w, width),
            "height": (h * (F.lit(float(width)) / w)).cast("int"),
            "width": F.lit(width),
        }
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double"))


def motion_score(clips: DataFrame, flows: DataFrame) -> DataFrame:
    """Mean flow over pairs, pixels and both directions; NaN without pairs.

    Signed: opposite motions cancel. All maps of a clip have one shape, so the
    mean of means is a quotient of two sums and combines before the shuffle.
    """
    sums = flows.select(
        "clip_id",
        (_total(F.col("u")) + _total(F.col("v"))).alias("s"),
        (2 * F.size("u")).cast("bigint").alias("n"),
    )
    means = sums.groupBy("clip_id").agg(F.try_divide(F.sum("s"), F.sum("n")).alias("motion_flow"))
    return clips.select("clip_id").join(means, "clip_id", "left").withColumn(
        "motion_flow", F.coalesce("motion_flow", F.lit(float("nan")))
    )


def surviving_tracks(tracks: DataFrame) -> DataFrame:
    """Track segments of points not lost so far; a lost point never returns.

    The pair that loses a point is a minimum per point, combined before the
    shuffle, instead of a running minimum over each point's whole history.
    """
    lost = (
        tracks.where("status = 0")
        .groupBy("clip_id", "point_id")
        .agg(F.min("pair_no").alias("lost_at"))
        .select(F.struct("clip_id", "point_id").alias("_point"), "lost_at")
    )
    keyed = tracks.withColumn("_point", F.struct("clip_id", "point_id"))
    return (
        attach(keyed, lost, "_point", F.col("pair_no"), how="left")
        .where(F.col("lost_at").isNull() | (F.col("pair_no") < F.col("lost_at")))
        .drop("_point", "lost_at")
    )


def track_motion(clips: DataFrame, tracks: DataFrame) -> DataFrame:
    """Mean length of surviving track segments; 0 when there are none."""
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    means = surviving_tracks(tracks).groupBy("clip_id").agg(F.avg(length).alias("motion_tracks"))
    return clips.select("clip_id").join(means, "clip_id", "left").withColumn(
        "motion_tracks", F.coalesce("motion_tracks", F.lit(0.0))
    )
