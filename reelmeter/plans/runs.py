"""A scoring run: clips in, stored results and errors out, resumable."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmeter.operators.ordering import limit_run, range_slice, seeded_shuffle
from reelmeter.operators.sampling import sample_uniform
from reelmeter.operators.scoring import error_rows, run_log, score_batches
from reelmeter.plans.registry import Metric, get_metric
from reelmeter.session import stored
from reelmeter.sources.files import scene_files, scene_manifest
from reelmeter.sources.results import (
    first_links,
    id_first,
    read_other_runs,
    run_path,
    skip_processed,
    write_results,
    write_scored,
)


@dataclass(frozen=True)
class Model:
    """Plug-in: ``load()`` once per worker process, ``infer(model, batch)`` per batch of items."""

    load: Callable[[], Any]
    infer: Callable[[Any, Any], Sequence]
    batch_size: int = 32


def scene_clips(
    spark: SparkSession, catalog: DataFrame, scenes_root: str, start: int | None = None, end: int | None = None
) -> DataFrame:
    """Scenes of the catalog titles ``start <= position < end``, in catalog order."""
    titles = range_slice(first_links(catalog), ["ord"], start, end)
    return scene_manifest(titles, scene_files(spark, scenes_root))


def sampled_frames(
    clips: DataFrame,
    meta: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    desired_fps: float | None = None,
    discard_last: float | None = None,
) -> DataFrame:
    """Frames of the clips at a fixed time step.

    Frame numbers are worked out from ``meta`` first. ``fetch`` gets rows
    (clip_id, sample_no, t_s, frame_no) and returns them with pixels: a join
    to a frame table, or a decoder run in ``mapInPandas``.
    """
    wanted = meta.join(clips.select(F.col("video_id").alias("clip_id")), "clip_id", "left_semi")
    return fetch(sample_uniform(wanted, desired_fps, discard_last))


def run_metric(
    spark: SparkSession,
    metric: str | Metric,
    clips: DataFrame,
    root: str,
    run_id: str,
    model: Model | None = None,
    frames: Callable[[DataFrame], DataFrame] | None = None,
    start: int | None = None,
    end: int | None = None,
    resume: bool = True,
    trial_every: int | None = None,
) -> DataFrame:
    """Score clips with one metric and store what came out.

    ``clips`` has ``video_id`` (and whatever ``frames`` or the model needs);
    ``frames`` maps the clips that are left to frame rows keyed by ``clip_id``.
    Stored ids are removed before any frame is read. Model outputs go to
    ``root/scored`` once, split into ok and failed; results are summed up from
    there, so a lost executor never causes scoring to be repeated after that
    point. A clip with a failed item has no result and is retried next time.
    ``root/log`` has a row per clip for the reports in ``runlog`` (ordered by
    ``finished, video_id``). ``trial_every`` scores one checkpoint's worth of
    clips and 50 more.
    """
    metric = get_metric(metric) if isinstance(metric, str) else metric
    clips = clips.dropDuplicates(["video_id"])
    if start is not None or end is not None:
        clips = range_slice(clips, ["video_id"], start, end).drop("idx")
    if resume:
        clips = skip_processed(clips, read_other_runs(spark, f"{root}/results", metric.name, run_id))
    if trial_every is not None:
        # a trial over the whole list takes clips from all over it
        whole_list = start is None and end is None
        clips = seeded_shuffle(clips, "video_id") if whole_list else clips
        order = ["shuffle_key", "video_id"] if whole_list else ["video_id"]
        clips = limit_run(clips, order, trial_every).drop("shuffle_key")
    clips = stored(clips, "clips")  # one list for all that follows
    ids = clips.select(F.col("video_id").alias("clip_id"))
    asked = clips.withColumnRenamed("video_id", "clip_id") if metric.asks == "clips" else frames(clips)
    items = metric.items(asked)
    scored, done = None, ids
    if metric.answer is not None:
        scored = write_scored(
            score_batches(items, model.load, model.infer, metric.answer, metric.keys, model.batch_size),
            f"{root}/scored", metric.name, run_id,
        )
        run_log(scored, metric.name).write.mode("overwrite").parquet(
            run_path(f"{root}/log", metric.name, run_id)
        )
        failed = error_rows(scored).select("clip_id").distinct()
        done = ids.join(failed, "clip_id", "left_anti")
        scored = scored.join(failed, "clip_id", "left_anti")
    results = metric.summarise(done, items, scored).withColumnRenamed("clip_id", "video_id")
    write_results(id_first(results), f"{root}/results", metric.name, run_id)
    return spark.read.parquet(run_path(f"{root}/results", metric.name, run_id))


def run_all(
    spark: SparkSession, names: Sequence[str], clips: DataFrame, root: str, run_id: str,
    models: dict[str, Model], **options,
) -> dict[str, DataFrame]:
    """The metrics one after the other over the same clips."""
    for name in names:
        get_metric(name)
    return {
        name: run_metric(spark, name, clips, root, run_id, models.get(name), **options) for name in names
    }
