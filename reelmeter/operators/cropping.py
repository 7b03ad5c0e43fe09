"""Black-bar analysis and crop plans on frame tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmeter.fixed_values import BLACK_RATIO, BRIGHT_RATIO, DARKNESS, SCAN_END, SCAN_START, SCAN_STEP
from reelmeter.functions.frames import black_region, bright_share, crop_boundary, region_rows, to_gray
from reelmeter.operators.ordering import attach
from reelmeter.operators.sampling import frames_at, linspace_numbers


def gray_frames(frames: DataFrame) -> DataFrame:
    """Frames with a ``gray`` column in place of their colour pixels."""
    return frames.withColumn("gray", to_gray(F.col("pixels"), F.col("channels"))).drop("pixels", "channels")


def row_brightness(gray: DataFrame, darkness: int = DARKNESS) -> DataFrame:
    """Bright pixels per row instead of the pixels themselves."""
    bright = bright_share(F.col("gray"), F.col("height"), F.col("width"), darkness)
    return gray.withColumn("bright", bright).drop("gray")


def frame_crop(
    rows: DataFrame,
    check_top: bool = True,
    check_bottom: bool = True,
    simple_percent: float | None = None,
    black_ratio: float = BLACK_RATIO,
    bright_ratio: float = BRIGHT_RATIO,
    scan: tuple[float, float, float] = (SCAN_START, SCAN_END, SCAN_STEP),
) -> DataFrame:
    """Top and bottom crop line of each frame of ``row_brightness``; null is no crop."""
    bright, height, width = F.col("bright"), F.col("height"), F.col("width")
    none = F.lit(None).cast("int")
    if simple_percent:
        cut = region_rows(height, simple_percent)

        def side(position: str, line):
            return F.when(
                black_region(bright, height, width, position, simple_percent, black_ratio), line
            )

        top, bottom = side("top", cut), side("bottom", height - cut)
    else:
        top = crop_boundary(bright, height, width, "top", bright_ratio, scan)
        bottom = crop_boundary(bright, height, width, "bottom", bright_ratio, scan)
    return rows.withColumns(
        {"top_crop": top if check_top else none, "bottom_crop": bottom if check_bottom else none}
    ).drop("bright")


def median_crop(crops: DataFrame) -> DataFrame:
    """Exact median of each side per clip, truncated.

    Spark's median keeps counts per distinct value, here at most the frame
    height, and combines them before the shuffle.
    """
    return crops.groupBy("clip_id").agg(
        F.median("top_crop").cast("int").alias("top_crop"),
        F.median("bottom_crop").cast("int").alias("bottom_crop"),
        F.max("height").alias("height"),
    )


def crop_status(plan: DataFrame) -> DataFrame:
    """Rows to keep: ``start_y <= y < end_y``, and whether that is a valid crop."""
    start, end = F.coalesce("top_crop", F.lit(0)), F.coalesce("bottom_crop", "height")
    return plan.select(
        "clip_id",
        start.alias("start_y"),
        end.alias("end_y"),
        F.when(F.col("top_crop").isNull() & F.col("bottom_crop").isNull(), "skipped")
        .when(end - start <= 0, "invalid")
        .otherwise("cropped")
        .alias("status"),
    )


def clip_crop_plan(
    meta: DataFrame,
    frames: DataFrame,
    sample_frames: int = 5,
    darkness: int = DARKNESS,
    fetch: Callable[[DataFrame], DataFrame] | None = None,
    **rules,
) -> DataFrame:
    """Crop plan per clip from a few evenly spaced frames.

    Sampled frame numbers come from metadata and are matched where the frames
    are, so no pixels move. A clip without a readable frame is skipped.
    ``frames`` may be an index without pixels; then ``fetch`` reads those of the sampled rows.
    """
    numbers = linspace_numbers(F.col("total_frames"), sample_frames)
    sampled = frames_at(frames, meta.select("clip_id", numbers.alias("wanted")))
    if fetch is not None:
        sampled = fetch(sampled)
    gray = gray_frames(sampled) if "gray" not in sampled.columns else sampled
    medians = median_crop(frame_crop(row_brightness(gray, darkness), **rules))
    every_clip = meta.select("clip_id", F.col("height").alias("meta_height")).join(
        medians, "clip_id", "left"
    )
    return crop_status(
        every_clip.withColumn("height", F.coalesce("height", "meta_height")).drop("meta_height")
    )


def apply_crop(frames: DataFrame, plan: DataFrame, depth: int = 3) -> DataFrame:
    """Kept pixel rows of every frame, full width; other clips stay as they are.

    A byte slice of row-major pixels, done in the JVM.
    """
    lines = plan.where("status = 'cropped'").select("clip_id", "start_y", "end_y")
    joined = attach(frames, lines, "clip_id", F.col("frame_no"), how="left")
    start = F.coalesce("start_y", F.lit(0))
    end = F.least(F.coalesce("end_y", "height"), "height")
    line_bytes = F.col("width") * F.lit(depth)
    return joined.withColumns(
        {
            "pixels": F.substring("pixels", start * line_bytes + 1, (end - start) * line_bytes),
            "height": (end - start).cast("int"),
        }
    ).drop("start_y", "end_y")


def crop_clips(
    meta: DataFrame,
    frames: DataFrame,
    bottom_percent: float | None = 10.0,
    top_percent: float | None = None,
    smart: bool = True,
    depth: int = 3,
    **rules,
) -> DataFrame:
    """Frames without black bars.

    A side is looked at when its percent is given. Smart mode ignores the
    values; otherwise one percentage is used for both sides, the bottom's if given.
    """
    simple = None if smart else (bottom_percent if bottom_percent is not None else top_percent)
    plan = clip_crop_plan(
        meta,
        frames,
        check_top=top_percent is not None,
        check_bottom=bottom_percent is not None,
        simple_percent=simple,
        **rules,
    )
    return apply_crop(frames, plan, depth)
