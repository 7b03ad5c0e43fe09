"""Metrics by name: what each is asked of, what a model returns, how it is summed up."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmeter.functions.text import base_name
from reelmeter.operators import metrics
from reelmeter.operators.cropping import gray_frames
from reelmeter.operators.motion import flow_maps, frame_pairs, motion_score
from reelmeter.operators.sampling import stride
from reelmeter.operators.scoring import prompt_fanout, question_fanout, scored_rows
from reelmeter.sources.files import default_questions, drop_prompt_questions, shot_prompts

_DETECTIONS = "array<struct<x1:double,y1:double,x2:double,y2:double,label:string,conf:double>>"


@dataclass(frozen=True)
class Metric:
    """``items`` turns frames (or clips) into what the model is asked, one row an
    output; ``summarise(clips, items, scored)`` gives the rows of the result table.
    A metric without ``answer`` needs no model: ``summarise`` works on the items.
    """

    name: str
    asks: str  # "frames" or "clips"
    keys: tuple[str, ...]
    answer: str | None
    items: Callable[[DataFrame], DataFrame]
    summarise: Callable[[DataFrame, DataFrame, DataFrame | None], DataFrame]


def _named(frames: DataFrame) -> DataFrame:
    """Frames with a ``file`` name; one made of the position if the source has no files."""
    if "file" in frames.columns:
        return frames
    if "path" in frames.columns:
        return frames.withColumn("file", base_name(F.col("path")))
    return frames.withColumn("file", F.format_string("frame_%d", F.col("sample_no")))


def _motion(clips: DataFrame, frames: DataFrame, _) -> DataFrame:
    gray = frames if "gray" in frames.columns else gray_frames(frames)
    pairs = frame_pairs(gray, keep=("height", "width"))
    return motion_score(clips, flow_maps(pairs))


def _subjects(clips: DataFrame, items: DataFrame, scored: DataFrame) -> DataFrame:
    frames = scored.select("clip_id", F.col("sample_no").alias("frame_no"))
    detections = scored_rows(scored).select(
        "clip_id", F.col("sample_no").alias("frame_no"), F.inline("result")
    )
    return metrics.subjects(clips, frames, metrics.confidence_filter(detections))


def _shots(clips: DataFrame, items: DataFrame, scored: DataFrame) -> DataFrame:
    answers = scored_rows(scored).select(
        "clip_id", F.col("sample_no").alias("frame_no"), "p_idx", F.col("result").alias("answer")
    )
    return metrics.shot_categories(clips, answers)


def _votes(clips: DataFrame, items: DataFrame, scored: DataFrame) -> DataFrame:
    questions = drop_prompt_questions(default_questions(scored.sparkSession))
    return metrics.vision_reward(scored_rows(scored).withColumnRenamed("result", "answer"), questions)


def _questions(clips: DataFrame) -> DataFrame:
    return question_fanout(clips, drop_prompt_questions(default_questions(clips.sparkSession)))


_BUILT_IN = (
    Metric(
        "aesthetics", "frames", ("clip_id", "sample_no"), "struct<score:double>", lambda frames: frames,
        lambda clips, items, scored: metrics.aesthetics(clips, scored_rows(scored)),
    ),
    Metric("motion", "frames", ("clip_id", "sample_no"), None, lambda frames: frames, _motion),
    Metric(
        "shots", "frames", ("clip_id", "sample_no", "p_idx"), "map<string,string>",
        lambda frames: prompt_fanout(frames, shot_prompts(frames.sparkSession)), _shots,
    ),
    Metric("subjects", "frames", ("clip_id", "sample_no"), _DETECTIONS, lambda frames: frames, _subjects),
    Metric("vision_reward", "clips", ("clip_id", "q_idx"), "string", _questions, _votes),
    Metric(
        "nsfw", "frames", ("clip_id", "sample_no", "file"), "struct<label:string>", _named,
        lambda clips, items, scored: metrics.nsfw(clips, scored_rows(scored)),
    ),
    Metric(
        "watermark", "frames", ("clip_id", "sample_no", "file"), "struct<score:double>", _named,
        lambda clips, items, scored: metrics.watermark(clips, scored_rows(scored)),
    ),
)
_METRICS = {metric.name: metric for metric in _BUILT_IN}


def register_metric(metric: Metric) -> None:
    _METRICS[metric.name] = metric


def get_metric(name: str) -> Metric:
    if name not in _METRICS:
        raise NotImplementedError(f"metric {name} is not registered")
    return _METRICS[name]


def metric_names() -> list[str]:
    return list(_METRICS)


def every_nth(metric: Metric, n: int) -> Metric:
    """The metric on every n-th sampled frame only."""
    inner = metric.items
    return Metric(
        metric.name, metric.asks, metric.keys, metric.answer,
        lambda frames: inner(stride(frames, n)), metric.summarise,
    )
