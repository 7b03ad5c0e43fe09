"""Clip metrics from scores, labels, detections and answers.

Averages are sums and counts, combined before each shuffle, so a clip may hold
any share of the rows. Per-frame maps are the one nested output; a map holds at
most ``PART_FRAMES`` frames and a longer clip continues on further rows
(``part_no`` 0, 1, ...), each carrying the clip's averages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelmeter.fixed_values import OTHER_BUCKET, SUBJECT_BUCKETS
from reelmeter.functions.arithmetic import whole
from reelmeter.functions.text import bucket, strip_pad
from reelmeter.operators.ordering import attach
from reelmeter.session import few_rows, stored, tasks_for

PART_FRAMES = 4096
#: Frames whose counts per label a task gathers.
TASK_FRAMES = 125_000


def by_field(name: str):
    """Comparator on one field of array entries, for entries that hold maps."""
    return lambda a, b: F.when(a[name] < b[name], -1).when(a[name] > b[name], 1).otherwise(0)


def frame_parts(
    rows: DataFrame, index: str, key: Column, value: Column, name: str, part_frames: int = PART_FRAMES
) -> DataFrame:
    """Rows (clip_id, part_no, map of key to value in frame order)."""
    entry = F.struct(F.col(index).alias("i"), key.alias("k"), value.alias("v"))
    ordered = F.array_sort(F.collect_list(entry), by_field("i"))
    return (
        rows.groupBy("clip_id", whole(index, part_frames).cast("int").alias("part_no"))
        .agg(ordered.alias("_e"))
        .select(
            "clip_id",
            "part_no",
            F.map_from_entries(
                F.transform("_e", lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))
            ).alias(name),
        )
    )


def with_parts(summary: DataFrame, parts: DataFrame, name: str) -> DataFrame:
    """Averages and per-frame maps together; a clip without frames keeps an empty map.

    ``summary`` has a row per clip and its number of rows as ``_n`` (null without any).
    """
    summary = stored(summary, "clip-summary")
    filled = attach(parts, summary.where("_n is not null"), "clip_id", F.col("part_no"), store=False)
    empty = summary.where("_n is null").withColumns(
        {"part_no": F.lit(0), name: F.create_map().cast(parts.schema[name].dataType)}
    )
    columns = ["clip_id", "part_no", *[c for c in summary.columns if c not in ("clip_id", "_n")], name]
    return filled.select(*columns).unionByName(empty.select(*columns))


def _clip_mean(clips: DataFrame, rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Mean per clip (NaN without rows) and the number of rows as ``_n``."""
    means = rows.groupBy("clip_id").agg(F.avg(value).alias(name), F.count(F.lit(1)).alias("_n"))
    return (
        clips.select("clip_id")
        .join(means, "clip_id", "left")
        .withColumn(name, F.coalesce(name, F.lit(float("nan"))))
    )


def _scores(clips: DataFrame, scores: DataFrame, name: str) -> DataFrame:
    return _clip_mean(clips, scores, F.col("score").cast("double"), name)


def _unsafe_share(clips: DataFrame, labels: DataFrame, unsafe: str = "nsfw") -> DataFrame:
    hit = F.when(F.col("label") == unsafe, 1.0).otherwise(0.0)
    return _clip_mean(clips, labels, hit, "avg_nsfw_score")


def avg_aesthetic(clips: DataFrame, scores: DataFrame) -> DataFrame:
    """Mean score per clip; NaN for a clip without frames."""
    return _scores(clips, scores, "avg_aesthetic_score").drop("_n")


def aesthetics(clips: DataFrame, scores: DataFrame, part_frames: int = PART_FRAMES) -> DataFrame:
    """Mean score and map of frame position to score."""
    parts = frame_parts(
        scores, "sample_no", F.col("sample_no").cast("int"), F.col("score").cast("double"),
        "frame_aesthetic_scores", part_frames,
    )
    return with_parts(_scores(clips, scores, "avg_aesthetic_score"), parts, "frame_aesthetic_scores")


def nsfw_share(clips: DataFrame, labels: DataFrame, unsafe: str = "nsfw") -> DataFrame:
    """Share of frames labelled exactly ``unsafe``."""
    return _unsafe_share(clips, labels, unsafe).drop("_n")


def nsfw(clips: DataFrame, labels: DataFrame, part_frames: int = PART_FRAMES) -> DataFrame:
    """Unsafe share and map of frame file to label."""
    parts = frame_parts(
        labels, "sample_no", F.col("file"), F.col("label"), "frame_nsfw_results", part_frames
    )
    return with_parts(_unsafe_share(clips, labels), parts, "frame_nsfw_results")


def watermark_avg(clips: DataFrame, scores: DataFrame) -> DataFrame:
    """Mean score per clip; NaN for a clip without frames."""
    return _scores(clips, scores, "avg_watermark_score").drop("_n")


def watermark(clips: DataFrame, scores: DataFrame, part_frames: int = PART_FRAMES) -> DataFrame:
    """Mean score and map of frame file to score."""
    parts = frame_parts(
        scores, "sample_no", F.col("file"), F.col("score").cast("double"),
        "frame_watermark_results", part_frames,
    )
    return with_parts(_scores(clips, scores, "avg_watermark_score"), parts, "frame_watermark_results")


def confidence_filter(detections: DataFrame, threshold: float = 0.25) -> DataFrame:
    return detections.where(F.col("conf") > threshold)


def label_counts(detections: DataFrame) -> DataFrame:
    """Detections per (clip, frame, lower-cased label)."""
    return detections.groupBy("clip_id", "frame_no", F.lower("label").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _bucket_names(buckets) -> list[str]:
    return [name for name, _ in buckets] + [OTHER_BUCKET]


def bucketed_counts(frames: DataFrame, detections: DataFrame, buckets=SUBJECT_BUCKETS) -> DataFrame:
    """Detections per frame and bucket with their total; frames without any count 0."""
    names = _bucket_names(buckets)
    counts = (
        detections.withColumn("_b", bucket(F.col("label"), buckets))
        .groupBy("clip_id", "frame_no")
        .agg(*[F.count_if(F.col("_b") == name).alias(name) for name in names], F.count(F.lit(1)).alias("total"))
    )
    return (
        frames.select("clip_id", "frame_no")
        .join(counts, ["clip_id", "frame_no"], "left")
        .fillna(0, [*names, "total"])
    )


def frame_counts(frames: DataFrame, detections: DataFrame, buckets=SUBJECT_BUCKETS) -> DataFrame:
    """Per frame, the map of label to count (plus ``total``) and the bucket counts.

    One pass: detections shrink to counts per label before the shuffle, and
    both counts are read off the labels of a frame. The map has no more
    entries than the detector has classes. Counts and frames meet in tasks of
    about ``TASK_FRAMES`` frames, which are counted first.
    """
    names = _bucket_names(buckets)
    tasks, frame = tasks_for(frames, TASK_FRAMES), ["clip_id", "frame_no"]
    label_bucket = bucket(F.col("label"), buckets)
    named = F.when(F.col("label") != "total", F.struct("label", F.col("n").cast("int")))
    counted = (
        label_counts(detections)
        .repartition(tasks, *frame)
        .withColumn("_b", label_bucket)
        .groupBy(*frame)
        .agg(
            F.map_from_entries(F.array_sort(F.collect_list(named))).alias("_m"),
            F.sum(F.when(F.col("label") != "total", F.col("n"))).cast("int").alias("_t"),
            *[F.sum(F.when(F.col("_b") == name, F.col("n"))).cast("int").alias(name) for name in names],
            F.sum("n").cast("int").alias("total"),
        )
    )
    empty = F.create_map().cast("map<string,int>")
    labelled_total = F.create_map(F.lit("total"), F.coalesce("_t", F.lit(0)))
    return (
        frames.select(*frame)
        .repartition(tasks, *frame)
        .join(counted, frame, "left")
        .select(
            "clip_id",
            "frame_no",
            F.map_concat(F.coalesce("_m", empty), labelled_total).alias("raw_counts"),
            F.struct(*[F.coalesce(n, F.lit(0)).alias(n) for n in (*names, "total")]).alias("bucketed_counts"),
        )
    )


def raw_counts(frames: DataFrame, detections: DataFrame) -> DataFrame:
    """Map of lower-cased label to count per frame, plus ``total``."""
    return frame_counts(frames, detections).select("clip_id", "frame_no", "raw_counts")


def subject_averages(
    clips: DataFrame,
    frames: DataFrame,
    detections: DataFrame,
    buckets=SUBJECT_BUCKETS,
    shown: Sequence[str] = ("humans", "animals"),
) -> DataFrame:
    """Detections per frame, in total and of the shown buckets; 0.0 without frames.

    A mean over frames is detections divided by frames: no per-frame table is
    built, and frames without detections count by themselves.
    """
    counts = (
        detections.withColumn("_b", bucket(F.col("label"), buckets))
        .groupBy("clip_id")
        .agg(
            F.count(F.lit(1)).alias("subjects"),
            *[F.count_if(F.col("_b") == name).alias(name) for name in shown],
        )
    )
    n_frames = frames.groupBy("clip_id").agg(F.count(F.lit(1)).alias("n_frames"))

    def mean(name: str) -> Column:
        return F.coalesce(F.try_divide(F.col(name).cast("double"), F.col("n_frames").cast("double")), F.lit(0.0))

    return (
        clips.select("clip_id")
        .join(n_frames, "clip_id", "left")
        .join(counts, "clip_id", "left")
        .select("clip_id", *[mean(n).alias(f"avg_{n}") for n in ("subjects", *shown)])
    )


def subjects(
    clips: DataFrame, frames: DataFrame, detections: DataFrame, part_frames: int = PART_FRAMES
) -> DataFrame:
    """Averages and map of frame to its raw and bucketed counts.

    Both are read off the counts per frame, which are written once.
    """
    per_frame = stored(frame_counts(frames, detections), "frame-counts")
    shown = {"avg_subjects": "total", "avg_humans": "humans", "avg_animals": "animals"}
    means = per_frame.groupBy("clip_id").agg(
        *[F.avg(f"bucketed_counts.{field}").alias(name) for name, field in shown.items()],
        F.count(F.lit(1)).alias("_n"),
    )
    summary = clips.select("clip_id").join(means, "clip_id", "left").fillna(0.0, list(shown))
    parts = frame_parts(
        per_frame, "frame_no", F.col("frame_no").cast("int"), F.struct("raw_counts", "bucketed_counts"),
        "frame_counts", part_frames,
    )
    return with_parts(summary, parts, "frame_counts")


def frame_answers(answers: DataFrame) -> DataFrame:
    """Answers of each frame as an array in prompt order, padding removed."""
    entry = F.struct("p_idx", strip_pad(F.col("answer")).alias("a"))
    by_prompt = F.array_sort(F.collect_list(entry), by_field("p_idx"))
    return (
        answers.groupBy("clip_id", "frame_no")
        .agg(by_prompt.alias("_e"))
        .select("clip_id", "frame_no", F.transform("_e", lambda e: e["a"]).alias("answers"))
    )


def shot_categories(clips: DataFrame, answers: DataFrame, part_frames: int = PART_FRAMES) -> DataFrame:
    """Map of frame to its answers in prompt order (one answer per frame and prompt)."""
    parts = frame_parts(
        frame_answers(answers), "frame_no", F.col("frame_no").cast("int"), F.col("answers"),
        "frame_shot_categorization", part_frames,
    )
    counts = answers.groupBy("clip_id").agg(F.count(F.lit(1)).alias("_n"))
    summary = clips.select("clip_id").join(counts, "clip_id", "left")
    return with_parts(summary, parts, "frame_shot_categorization")


def vision_reward(answers: DataFrame, questions: DataFrame) -> DataFrame:
    """Signed weighted vote per clip: the weight counts for "yes", against otherwise.

    The answer is compared as it is, without trimming or lower-casing. A clip
    has one answer per question; weights are looked up in a literal map of the
    few questions, and answers to other questions do not count.
    """
    yes = F.col("answer") == "yes"
    pairs = [F.lit(x) for row in few_rows(questions.select("q_idx", "weight")) for x in row]
    signed = (
        answers.withColumn("weight", F.create_map(*pairs)[F.col("q_idx")])
        .where("weight is not null")
        .select(
            "clip_id",
            "q_idx",
            F.when(yes, F.col("weight")).otherwise(-F.col("weight")).alias("w"),
            F.when(yes, 1).otherwise(-1).alias("sign"),
        )
    )
    return (
        signed.groupBy("clip_id")
        .agg(F.avg("w").alias("avg_vision_reward"), F.array_sort(F.collect_list(F.struct("q_idx", "sign"))).alias("_e"))
        .select("clip_id", "avg_vision_reward", F.col("_e.sign").alias("frame_wise_rewards"))
    )
