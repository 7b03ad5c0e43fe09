"""Frame selection from metadata: which frames of which clip, before any pixel is read."""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmeter.functions.arithmetic import whole
from reelmeter.functions.text import clock_label
from reelmeter.functions.video import duration
from reelmeter.operators.ordering import attach, dense_index
from reelmeter.session import task_count

_BLOCK = 1 << 16


def explode_range(df: DataFrame, count: Column, name: str, spread: bool = False) -> DataFrame:
    """One row per integer ``0 .. count-1``; no array is longer than one block.

    ``spread`` shuffles the blocks (a few numbers each) before they are
    unfolded, so that neither few input splits nor one very long clip leaves
    the unfolding to few tasks.
    """
    keep = df.columns
    blocks = (
        df.withColumn("_n", count.cast("bigint"))
        .where("_n > 0")
        .withColumn("_from", F.explode(F.expr(f"sequence(0L, _n - 1, {_BLOCK}L)")))
    )
    if spread:
        blocks = blocks.repartition(task_count(df.sparkSession), "clip_id", "_from")
    return blocks.select(
        *keep,
        F.explode(
            F.sequence(F.col("_from"), F.least(F.col("_from") + (_BLOCK - 1), F.col("_n") - 1))
        ).alias(name),
    )


def _once(value: Column) -> Column:
    """A value that is worked out once a row, although several conditions look at it."""
    return F.explode(F.array(value))


def _step_is_exact(step: float) -> bool:
    """Whether adding ``step`` up to 2**30 times never rounds."""
    return step.as_integer_ratio()[0].bit_length() <= 20


@cache
def sum_intervals(step: float, most: int = 1 << 40) -> tuple[tuple[int, float, float], ...]:
    """(first k, sum at it, increment): how sums of ``step``, added one by one in doubles, grow up to ``most`` times.

    Between two powers of two all doubles are the same distance apart, so an addition there always adds
    the same: the step rounded to that distance. Additions that reach the next power of two are
    made one by one, as is one whose rounding falls exactly between two doubles and so goes to the even one;
    from an even sum, that adds the same every time. A hundred intervals or so describe any number of additions.
    """
    found, k, t = [], 0, 0.0
    while k < most:
        after = t + step
        if not math.isfinite(after) or after == t:  # the step no longer counts
            found.append((k, t, 0.0))
            break
        grown, ulp = after - t, math.ulp(after)
        level = math.frexp(t)[1] == math.frexp(after)[1] and t > 0
        to_even = math.fmod(step, ulp) * 2 == ulp and t / ulp % 2 == 1
        n = 1
        if level and not to_even:  # additions that stay below the next power of two; t + n * grown is exact there
            n = max(1, int((math.ldexp(1.0, math.frexp(after)[1]) - t) / grown) - 1)
        # a sum that the interval before also gives needs none of its own, unless more sums follow from it
        if n > 1 or not found or t != found[-1][1] + (k - found[-1][0]) * found[-1][2]:
            found.append((k, t, grown))
        k, t = k + n, t + n * grown
    return tuple(found)


def repeated_sum(k: Column, step: float) -> Column:
    """``step`` added ``k`` times in double arithmetic.

    Sample times grow by repeated addition, whose rounding decides ties of
    ``round(t * fps)``. For steps that add exactly this is a product; for
    others a choice among the few intervals in which sums grow evenly (``sum_intervals``).
    """
    if _step_is_exact(step):
        return k * F.lit(step)
    def chosen(intervals) -> Column:
        if len(intervals) == 1:
            first, start, grown = intervals[0]
            return F.lit(start) + (k - first) * F.lit(grown)
        middle = len(intervals) // 2
        return F.when(k < intervals[middle][0], chosen(intervals[:middle])).otherwise(chosen(intervals[middle:]))

    return chosen(sum_intervals(step))


def sample_times(
    meta: DataFrame,
    desired_fps: float | None = None,
    discard_last: float | None = None,
    include_end: bool = False,
) -> DataFrame:
    """Rows (clip_id, sample_no, t_s, frame_no) at a fixed time step.

    ``t`` runs from 0 in steps of ``1 / desired_fps`` (1 s by default) while it
    is before the end of the clip (or at it, with ``include_end``), not inside
    the discarded tail, and its frame exists. Frame numbers round half to even
    and may repeat when the step is finer than the clip.
    """
    step = 1.0 / desired_fps if desired_fps and desired_fps > 0 else 1.0
    clips = meta.select(
        "clip_id", "fps", "total_frames", duration(F.col("fps"), F.col("total_frames")).alias("_d")
    )
    grid = explode_range(clips, F.ceil(F.col("_d") / F.lit(step)) + 2, "sample_no", spread=True)
    t = F.col("t_s")
    inside = (t <= F.col("_d")) if include_end else (t < F.col("_d"))
    if discard_last is not None:
        inside = inside & (t <= F.col("_d") - F.lit(float(discard_last)))
    return (
        grid.withColumn("t_s", _once(repeated_sum(F.col("sample_no"), step)))
        .where(inside)
        .withColumn("frame_no", F.rint(t * F.col("fps")).cast("int"))
        .where(F.col("frame_no") < F.col("total_frames"))
        .select("clip_id", "sample_no", "t_s", "frame_no")
    )


def sample_uniform(
    meta: DataFrame, desired_fps: float | None = None, discard_last: float | None = None
) -> DataFrame:
    """Frames at a fixed time step, end of clip excluded."""
    return sample_times(meta, desired_fps, discard_last)


def sample_timestamped(
    meta: DataFrame,
    desired_fps: float | None = None,
    discard_last: float | None = None,
    frames: DataFrame | None = None,
) -> DataFrame:
    """Frames at a fixed time step under an MM:SS label; the last of a second wins.

    With ``frames``, unreadable (absent) frames drop out before labels are decided.
    """
    samples = sample_times(meta, desired_fps, discard_last, include_end=True)
    if frames is not None:
        samples = samples.join(
            frames.select("clip_id", "frame_no").distinct(), ["clip_id", "frame_no"], "left_semi"
        )
    return (
        samples.groupBy("clip_id", F.floor("t_s").cast("bigint").alias("second"))
        .agg(F.max("frame_no").alias("frame_no"))  # grows with time, so the last is the largest
        .select("clip_id", clock_label(F.col("second")).alias("label"), "frame_no")
    )


def fetch_frames(samples: DataFrame, frames: DataFrame) -> DataFrame:
    """Pixels of the sampled frames; keyed by clip and frame, so a long clip spreads out.

    A general join moves the pixels of all frames. Use ``sample_frames`` or
    ``frames_at`` where the choice can be made row by row, or a decoder that
    reads only what ``samples`` names.
    """
    return samples.join(frames, ["clip_id", "frame_no"])


def sample_frames(
    frames: DataFrame,
    meta: DataFrame,
    desired_fps: float | None = None,
    discard_last: float | None = None,
) -> DataFrame:
    """``fetch_frames(sample_uniform(...), frames)`` without moving pixels.

    Whether a frame is sampled, and as which sample, follows from its number
    and its clip's metadata: the few sample times that could round to it are
    tried in place. Metadata reaches the frames by ``attach`` (a broadcast up
    to its size bound). Sample times that are rounded sums lie within a step of the product.
    """
    step = 1.0 / desired_fps if desired_fps and desired_fps > 0 else 1.0
    clips = meta.where("fps > 0").select(
        "clip_id",
        F.col("fps").cast("double").alias("_fps"),
        F.col("total_frames").alias("_total"),
        duration(F.col("fps"), F.col("total_frames")).alias("_d"),
    )
    joined = attach(frames, clips, "clip_id", F.col("frame_no"), store=False)
    no, spacing = F.col("frame_no").cast("double"), F.col("_fps") * step
    nearest = (no + 1) / spacing
    drift = F.ceil(nearest * nearest * 2.3e-16)  # of a sum against the product, in steps
    low = F.greatest(F.lit(0), F.floor((no - 0.5) / spacing) - drift - 1).cast("bigint")
    high = (F.ceil((no + 0.5) / spacing) + drift + 1).cast("bigint")

    def is_sample(t: Column) -> Column:
        hit = (F.rint(t * F.col("_fps")) == no) & (t < F.col("_d"))
        if discard_last is not None:
            hit = hit & (t <= F.col("_d") - F.lit(float(discard_last)))
        return hit

    return (
        joined.where(no < F.col("_total"))
        .withColumn("sample_no", F.explode(F.sequence(low, high)))
        .withColumn("t_s", _once(repeated_sum(F.col("sample_no"), step)))
        .where(is_sample(F.col("t_s")))
        .drop("_fps", "_total", "_d")
    )


def frames_at(frames: DataFrame, wanted: DataFrame) -> DataFrame:
    """Frames whose number is in their clip's (short) ``wanted`` array; pixels stay in place."""
    joined = attach(frames, wanted.select("clip_id", "wanted"), "clip_id", F.col("frame_no"), store=False)
    return joined.where(F.array_contains("wanted", F.col("frame_no").cast("int"))).drop("wanted")


def keyframes(index: DataFrame) -> DataFrame:
    return index.where("is_key")


def stride(frames: DataFrame, every: int, index: str = "sample_no") -> DataFrame:
    """Every n-th frame from the first; positions are renumbered 0, 1, 2, ..."""
    if every < 1:
        raise ValueError("every must be an integer >= 1")
    return frames.where(F.pmod(F.col(index), F.lit(every)) == 0).withColumn(
        index, whole(index, every).cast("bigint")
    )


def linspace_numbers(total: Column, n: int, cap_to_total: bool = True) -> Column:
    """``n`` evenly spaced frame numbers from first to last, rounded down, as an array.

    ``cap_to_total`` takes at most as many as the clip has; otherwise short
    clips repeat frames. A clip without frames has none.
    """
    total = total.cast("bigint")
    count = F.least(F.lit(n).cast("bigint"), total) if cap_to_total else F.lit(n).cast("bigint")
    last = count - 1
    spacing = (total - 1).cast("double") / F.nullif(last, F.lit(0))

    def number(i: Column) -> Column:
        spaced = F.when(i == last, total - 1).otherwise(F.floor(i * spacing))
        return F.when(last == 0, F.lit(0)).otherwise(spaced).cast("int")

    return F.when(total > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), last), number))


def sample_linspace(meta: DataFrame, n: int, cap_to_total: bool = True) -> DataFrame:
    """A row per evenly spaced frame number of each clip."""
    numbers = linspace_numbers(F.col("total_frames"), n, cap_to_total)
    return meta.select("clip_id", F.posexplode(numbers).alias("sample_no", "frame_no")).withColumn(
        "sample_no", F.col("sample_no").cast("bigint")
    )


def sample_nearest_second(frames: DataFrame, cap: int = 24) -> DataFrame:
    """For each whole second up to the last timestamp, the frame nearest to it.

    Ties go to the lowest frame number; at most ``cap`` seconds are taken.
    Only the first and last frame between two whole seconds can be nearest to
    any second, so each clip is reduced to at most ``cap + 2`` pairs before the
    shuffle and no clip is ever gathered whole.
    """
    ts, no = F.col("ts_s").cast("double"), F.col("frame_no").cast("bigint")
    slot = F.least(F.greatest(F.floor(ts), F.lit(-1)), F.lit(cap)).cast("int")
    ends = (
        frames.groupBy("clip_id", slot.alias("slot"))
        .agg(
            F.min(F.struct(ts.alias("t"), no.alias("no"))).alias("first"),
            F.max(F.struct(ts.alias("t"), (-no).alias("no"))).alias("last"),
        )
        .withColumn("last", F.struct(F.col("last.t").alias("t"), (-F.col("last.no")).alias("no")))
    )
    # One row per clip with at most cap + 2 slots: bounded by construction.
    per_clip = ends.groupBy("clip_id").agg(
        F.max("last.t").alias("max_t"),
        F.collect_list(F.struct("slot", "first", "last")).alias("slots"),
    )
    seconds = explode_range(
        per_clip, F.least(F.floor("max_t") + 1, F.lit(cap)), "sec"
    ).withColumn("sec", F.col("sec").cast("int"))

    def distance(end: Column) -> Column:
        return F.struct(F.abs(end["t"] - F.col("sec")).alias("d"), end["no"].alias("no"))

    candidates = F.transform(
        "slots",
        lambda s: F.when(s["slot"] < F.col("sec"), distance(s["last"])).otherwise(distance(s["first"])),
    )
    return seconds.select(
        "clip_id", "sec", F.array_min(candidates)["no"].cast("bigint").alias("frame_no")
    )


def sample_dir_stride(frames: DataFrame, n: int = 24, max_group_rows: int | None = None) -> DataFrame:
    """First ``n`` of every ``max(total // n, 1)``-th frame of a directory, by ``path``."""
    extra = {} if max_group_rows is None else {"max_group_rows": max_group_rows}
    indexed = dense_index(frames.select("clip_id", "path"), ["clip_id"], ["path"], "frame_no", **extra)
    totals = frames.groupBy("clip_id").agg(F.count(F.lit(1)).alias("total"))
    step = F.greatest(whole("total", n), F.lit(1))
    picked = attach(indexed, totals, "clip_id", F.col("frame_no")).withColumn("step", step)
    return picked.where(
        (F.pmod("frame_no", "step") == 0) & (whole("frame_no", F.col("step")) < n)
    ).select(
        "clip_id",
        whole("frame_no", F.col("step")).alias("sample_no"),
        "frame_no",
        "path",
    )


def trim_plan(meta: DataFrame, discard_last: float) -> DataFrame:
    """Frames to keep of each clip after dropping its last seconds."""
    total = F.col("total_frames")
    if discard_last <= 0:
        return meta.select(
            "clip_id", F.lit("unchanged").alias("status"), total.cast("int").alias("frames_to_keep")
        )
    left = F.try_divide(total.cast("double"), F.col("fps").cast("double")) - F.lit(float(discard_last))
    kept = left > 0
    return meta.select(
        "clip_id",
        F.when(kept, "trimmed").otherwise("failed").alias("status"),
        F.when(kept, (left * F.col("fps")).cast("int")).alias("frames_to_keep"),
    )


def apply_trim(frames: DataFrame, plan: DataFrame) -> DataFrame:
    """Frames before the planned end; clips that cannot be trimmed keep all frames."""
    limits = plan.select("clip_id", "status", "frames_to_keep")
    joined = attach(frames, limits, "clip_id", F.col("frame_no"), store=False)
    keep = (F.col("status") != "trimmed") | (F.col("frame_no") < F.col("frames_to_keep"))
    return joined.where(keep).drop("status", "frames_to_keep")


def trim_summary(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count_if(F.col("status") != "failed").alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )
