"""Runs with commits inside: a long run is a row of chunks, each stored and committed before the next.

The list of clips is cut once and stored, so a run that is taken up again has
the same chunks, begins after the last whole one and scores no clip of a
committed chunk again. A chunk that was interrupted is written anew in its own folder.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmeter.operators.ordering import global_index
from reelmeter.plans.registry import Metric, get_metric
from reelmeter.plans.runs import Model, run_metric
from reelmeter.session import exists
from reelmeter.sources.results import read_results, run_path, skip_processed

COMMIT = "chunk_no int, clips long, results long, failed long, started timestamp, finished timestamp"


def chunk_run(run_id: str, chunk_no: int) -> str:
    """The run id that a chunk's results, scores and log are stored under."""
    return f"{run_id}.{chunk_no:06d}"


def planned(
    spark: SparkSession, clips: DataFrame, root: str, metric: str, run_id: str, chunk_clips: int
) -> DataFrame:
    """The clips of a run with ``chunk_no``, in order of ``video_id``; stored by the first call, read by later ones.

    Clips that other runs have results of are left out when the plan is made: ids are compared once a
    run, not once a chunk. Ids that occur several times are planned once.
    """
    path = run_path(f"{root}/plan", metric, run_id)
    planned_clips = clips.withColumn("chunk_no", F.lit(0))
    if not exists(spark, f"{path}/_SUCCESS"):
        _plan(spark, clips, root, metric, path, chunk_clips)
    return spark.read.schema(planned_clips.schema).parquet(path)


def _plan(spark: SparkSession, clips: DataFrame, root: str, metric: str, path: str, chunk_clips: int) -> None:
    stored = read_results(spark, f"{root}/results", metric, skip_damaged=True)
    left = skip_processed(clips.dropDuplicates(["video_id"]), stored)
    # positions come from one range shuffle, however many clips there are
    dealt = global_index(left, ["video_id"]).withColumn("chunk_no", F.floor(F.col("idx") / chunk_clips).cast("int"))
    dealt.drop("idx").write.mode("overwrite").partitionBy("chunk_no").parquet(path)


def commits(spark: SparkSession, root: str, metric: str, run_id: str) -> DataFrame:
    """A row per committed chunk of a run: what it held, what came out, when."""
    path = run_path(f"{root}/commits", metric, run_id)
    if not exists(spark, path):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).option("recursiveFileLookup", True).parquet(path)


def run_chunked(
    spark: SparkSession,
    metric: str | Metric,
    clips: DataFrame,
    root: str,
    run_id: str,
    model: Model | None = None,
    frames: Callable[[DataFrame], DataFrame] | None = None,
    chunk_clips: int = 10_000,
    max_chunks: int | None = None,
) -> DataFrame:
    """Score clips chunk by chunk; returns the commits of the run so far.

    Every chunk is a distributed run of its own (``run_metric``). Its commit record is written after
    its results, scores and log are whole, so what a lost driver leaves is either a committed chunk or one
    that the next call writes anew. ``max_chunks`` ends this call early; another call of the same
    ``run_id`` goes on. Clips with a failed item are in no result; a run with a new id takes them up.
    """
    metric = get_metric(metric) if isinstance(metric, str) else metric
    plan = planned(spark, clips, root, metric.name, run_id, chunk_clips)
    last = plan.agg(F.max("chunk_no")).first()[0]
    # a number per chunk, from one small file each
    done = {r["chunk_no"] for r in commits(spark, root, metric.name, run_id).select("chunk_no").collect()}
    todo = [n for n in range(0 if last is None else last + 1) if n not in done]
    for n in todo if max_chunks is None else todo[:max_chunks]:
        started = time.time()
        part = plan.where(F.col("chunk_no") == n).drop("chunk_no")
        results = run_metric(spark, metric, part, root, chunk_run(run_id, n), model, frames, resume=False)
        asked, scored = part.count(), results.select("video_id").distinct().count()
        record = spark.range(1).select(
            F.lit(n).alias("chunk_no"), F.lit(asked).cast("long").alias("clips"), F.lit(scored).cast("long").alias("results"),
            F.lit(asked - scored).cast("long").alias("failed"), F.timestamp_seconds(F.lit(started)).alias("started"),
            F.timestamp_seconds(F.lit(time.time())).alias("finished"),
        )
        path = run_path(f"{root}/commits", metric.name, run_id)
        record.coalesce(1).write.mode("overwrite").parquet(f"{path}/chunk-{n:06d}")
    return commits(spark, root, metric.name, run_id)


def committed_results(spark: SparkSession, root: str, metric: str, run_id: str) -> DataFrame | None:
    """Results of the run's committed chunks, with ``chunk_no``; None before the first.

    What an interrupted chunk left is not among them.
    """
    stored = read_results(spark, f"{root}/results", metric)
    if stored is None:
        return None
    # a row per chunk, from a record of some hundred bytes each
    done = commits(spark, root, metric, run_id).select(
        F.format_string(f"run-{run_id.replace('%', '%%')}.%06d", "chunk_no").alias("run_id"), "chunk_no"
    )
    return stored.join(done, "run_id")


def chunk_progress(chunks: DataFrame) -> DataFrame:
    """Seconds and rates of each chunk, and of the run up to it."""
    seconds = (F.unix_micros("finished") - F.unix_micros("started")) / 1e6
    return chunks.select(
        "chunk_no", "clips", "results", "failed", seconds.alias("seconds"),
        F.try_divide(seconds, F.col("results")).alias("s_per_item"),
        F.try_divide(F.col("results").cast("double"), seconds).alias("items_per_s"),
    )
