"""Scoring and progress as Structured Streaming jobs.

Every job writes each micro-batch to its own ``batch_id=N`` folder, replacing
that folder only. A batch that is replayed after a failure therefore ends with
the same rows, and a restarted job adds nothing for input it has seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmeter.plans.registry import Metric
from reelmeter.plans.runs import Model, run_metric
from reelmeter.session import scratch_path
from reelmeter.sources.files import clip_columns
from reelmeter.streaming.seen import SeenIds


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """A Parquet folder read as a stream, a bounded number of files at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def clip_stream(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """New ``*.mp4`` files of a folder as a stream of clips; file contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.mp4")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
        .select(*clip_columns())
    )


def _batch_path(sink: str, batch_id: int) -> str:
    return f"{sink}/batch_id={batch_id}"


def earlier_batches(spark: SparkSession, sink: str, batch_id: int) -> DataFrame | None:
    """Rows stored by batches before this one; None when there are none.

    The batch's own folder is left out: on a replay it holds the very rows
    that are about to be written again.
    """
    try:
        return spark.read.parquet(sink).where(F.col("batch_id") < batch_id)
    except AnalysisException:
        return None


def _run(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"):
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def score_stream(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    key: str = "video_id",
) -> None:
    """Score what has arrived, skipping ids that earlier batches stored.

    The skip comes before scoring: models never see a processed id again.
    An id that arrives several times in one batch is scored once, on one of its rows.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        done = earlier_batches(batch.sparkSession, sink, batch_id)
        if done is not None:
            batch = batch.join(done.select(key).distinct(), key, "left_anti")
        batch = batch.dropDuplicates([key])
        score(batch).write.mode("overwrite").parquet(_batch_path(sink, batch_id))

    _run(stream, handle, checkpoint)


def score_stream_indexed(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    seen: SeenIds,
    key: str = "video_id",
) -> None:
    """``score_stream`` with an index of seen ids: what a batch reads does not grow with the batches before it.

    Neither the sink nor its ids are read: filters of a fixed size tell new ids apart, and only buckets of
    the index in which some id may be known are opened. Rows with a null id are scored in every batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        fresh = seen.unseen(batch.dropDuplicates([key]), key, batch_id)
        path = _batch_path(sink, batch_id)
        score(fresh).write.mode("overwrite").parquet(path)
        # what was stored is what has been seen
        stored = batch.sparkSession.read.schema(batch.select(key).schema).parquet(path)
        seen.add(stored, key, batch_id)

    _run(stream, handle, checkpoint)


def stream_metric(
    clips: DataFrame,
    metric: str | Metric,
    root: str,
    checkpoint: str,
    model: Model | None = None,
    frames: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """A metric over clips as they arrive: each micro-batch is a run of its own.

    Runs skip what other runs stored and replace only themselves, so results
    are those of one run over all clips, and a replayed batch changes nothing.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        run_metric(batch.sparkSession, metric, batch, root, f"batch-{batch_id}", model, frames)

    _run(clips, handle, checkpoint)


def stream_throughput(
    stream: DataFrame, sink: str, checkpoint: str, time: str, width: str = "1 hour", delay: str = "1 hour"
) -> None:
    """Items per tumbling window, stored in update mode; late items within ``delay`` count."""
    counts = (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("items"))
        .select(F.col("w.start").alias("window_start"), "items")
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_path(sink, batch_id))

    _run(counts, handle, checkpoint, mode="update")


def latest_windows(spark: SparkSession, sink: str) -> DataFrame:
    """Current count of every window: the one stored last."""
    return (
        spark.read.parquet(sink)
        .groupBy("window_start")
        .agg(F.max_by("items", "batch_id").alias("items"))
    )


def stream_running_mean(stream: DataFrame, sink: str, checkpoint: str, value: str = "score") -> None:
    """Partial sums per clip and micro-batch, so means are available during the run.

    The stored partial sums are the state: nothing is kept in executors between
    batches, however many clips there are.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("clip_id").agg(
            F.sum(value).alias("total"), F.count(value).alias("n")
        ).write.mode("overwrite").parquet(_batch_path(sink, batch_id))

    _run(stream, handle, checkpoint)


def running_means(spark: SparkSession, sink: str) -> DataFrame:
    return (
        spark.read.parquet(sink)
        .groupBy("clip_id")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .select("clip_id", "n", F.try_divide("total", "n").alias("mean_score"))
    )


def stream_mean_state(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    value: str = "score",
    time: str | None = None,
    width: str = "1 day",
    delay: str = "1 day",
) -> None:
    """Running mean per clip with its sums in the state store; a batch stores the clips it changed, with their totals.

    A batch costs what it brings: neither earlier batches nor the sink are read. Without ``time``, state is a row per
    clip, for ever. With it, sums are kept per clip and window of ``width`` and leave the state when the
    watermark (``delay``) has passed the window; what was stored of it stays, so means stay those of all
    scores that arrived in time. Null scores count for nothing, a null clip is a clip.
    """
    keys = ["clip_id"]
    if time is not None:
        stream = stream.withWatermark(time, delay).withColumn("window", F.window(time, width))
        keys.append("window")
    totals = stream.groupBy(*keys).agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    if time is not None:
        totals = totals.select("clip_id", F.col("window.start").alias("window_start"), "total", "n")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_path(sink, batch_id))

    _run(totals, handle, checkpoint, mode="update")


def current_means(spark: SparkSession, sink: str) -> DataFrame:
    """Means by what ``stream_mean_state`` stored last of every clip, or of every window of a clip."""
    stored = spark.read.parquet(sink)
    keys = [c for c in ("clip_id", "window_start") if c in stored.columns]
    last = stored.groupBy(*keys).agg(F.max_by(F.struct("total", "n"), "batch_id").alias("last"))
    if len(keys) == 1:
        sums = last.select("clip_id", "last.total", "last.n")
    else:
        sums = last.groupBy("clip_id").agg(F.sum("last.total").alias("total"), F.sum("last.n").alias("n"))
    return sums.select("clip_id", "n", F.try_divide("total", "n").alias("mean_score"))


def stream_dedupe(
    stream: DataFrame, sink: str, checkpoint: str, time: str, delay: str, key: str = "video_id"
) -> None:
    """Each id once; ids are forgotten when the watermark has passed them."""
    once = stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_path(sink, batch_id))

    _run(once, handle, checkpoint)


def new_run(spark: SparkSession, name: str) -> tuple[str, str]:
    """Fresh (sink, checkpoint) folders in the shared scratch folder."""
    root = scratch_path(spark, name)
    return f"{root}/sink", f"{root}/checkpoint"
