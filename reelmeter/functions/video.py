"""Per-clip arithmetic on video metadata, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duration(fps: Column, total_frames: Column) -> Column:
    """Seconds; 0 for a clip without a frame rate."""
    return F.when(fps > 0, F.try_divide(total_frames.cast("double"), fps.cast("double"))).otherwise(
        F.lit(0.0)
    )


def video_info(meta: DataFrame) -> DataFrame:
    """Duration and ``WxH`` of each clip; a clip without metadata keeps an error."""
    return meta.select(
        "clip_id",
        duration(F.col("fps"), F.col("total_frames")).alias("duration_seconds"),
        "total_frames",
        "fps",
        "width",
        "height",
        F.format_string("%dx%d", "width", "height").alias("resolution"),
        F.when(
            F.col("fps").isNull() | F.col("total_frames").isNull(), F.lit("Cannot open video")
        ).alias("error"),
    )


def fit_dims(width: Column, height: Column, target_width: int, target_height: int) -> Column:
    """Largest size of the same shape inside the target, truncated to whole pixels."""
    ratio = F.least(
        F.try_divide(F.lit(float(target_width)), width.cast("double")),
        F.try_divide(F.lit(float(target_height)), height.cast("double")),
    )
    return F.struct(
        (width * ratio).cast("int").alias("width"), (height * ratio).cast("int").alias("height")
    )
