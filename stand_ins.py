"""Clip tables derived from the given test tables, which hold no video.

Each function states the mapping; everything is computed by Spark from whole
tables, so work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmeter.functions.frames import to_gray
from reelmeter.operators.ordering import dense_index
from reelmeter.session import scratch_path, tasks_for
from reelmeter.sources.frame_store import write_frame_store

# Buckets for part names: colour and temperature words, then sizes.
PART_BUCKETS = (("warm", ("red", "hot")), ("cool", ("blue", "cold")), ("big", ("large",)), ("little", ("small",)))

#: Order lines that a task joins to their orders.
TASK_LINES = 500_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def event_frames(spark: SparkSession, sf: str) -> DataFrame:
    """A frame per event: the user is the clip, time gives the order, value the score."""
    rows = events(spark, sf).select(
        F.col("user_id").alias("clip_id"), "ts", "event_id",
        F.col("value").alias("score"), F.col("event_type").alias("label"),
    )
    return dense_index(rows, ["clip_id"], ["ts", "event_id"])


def event_clips(spark: SparkSession, sf: str) -> DataFrame:
    """One clip per customer id, many without any frame."""
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("clip_id"))


def event_meta(spark: SparkSession, sf: str, fps: float = 2.0) -> DataFrame:
    return (
        events(spark, sf)
        .groupBy(F.col("user_id").alias("clip_id"))
        .agg(F.count(F.lit(1)).cast("int").alias("total_frames"))
        .withColumn("fps", F.lit(fps))
    )


def event_times(spark: SparkSession, sf: str) -> DataFrame:
    """Timestamps per clip: hours since 2024 read as seconds."""
    return events(spark, sf).select(
        F.col("user_id").alias("clip_id"),
        F.col("event_id").alias("frame_no"),
        ((F.unix_micros("ts") - F.lit(1704067200000000)) / F.lit(3600000000.0)).alias("ts_s"),
    )


def part_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Video metadata: size is the frame rate, whole price the frame count."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("clip_id"),
        F.col("p_size").cast("double").alias("fps"),
        F.col("p_retailprice").cast("int").alias("total_frames"),
        (F.col("p_size") * 16).alias("width"),
        (F.col("p_size") * 9 + 1).alias("height"),
    )


def part_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Short clips: as many frames as the part's size."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("clip_id"), F.col("p_size").alias("total_frames")
    )


def detection_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of detections: an order is a frame of its customer's clip."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("clip_id"), F.col("o_orderkey").alias("frame_no")
    )


def detections(spark: SparkSession, sf: str) -> DataFrame:
    """A detection per order line: the part's name, the quantity as confidence.

    Partitions are bounded by lines: sorts and counts of what the join puts together stay in its tasks.
    """
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    names = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    frames = detection_frames(spark, sf).withColumnRenamed("frame_no", "l_orderkey")
    tasks = tasks_for(lines, TASK_LINES)
    return (
        lines.join(names, "l_partkey")
        .repartition(tasks, "l_orderkey")
        .join(frames.repartition(tasks, "l_orderkey"), "l_orderkey")
        .select(
            "clip_id",
            F.col("l_orderkey").alias("frame_no"),
            F.col("p_name").alias("label"),
            (F.col("l_quantity") / 50).alias("conf"),
        )
    )


def embedding_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors as frames: the label is the clip, frames are numbered by vector id."""
    rows = table(spark, sf, "embeddings").select(F.col("label").alias("clip_id"), "vec_id", "embedding")
    return dense_index(rows, ["clip_id"], ["vec_id"])


def gray_frames(spark: SparkSession, sf: str) -> DataFrame:
    """8 x 8 gray frames: vector elements scaled to bytes."""
    byte = F.transform(
        "embedding",
        lambda x: F.least(
            F.lit(255), F.greatest(F.lit(0), F.floor((x.cast("double") + 0.55) * 232).cast("int"))
        ),
    )
    return embedding_frames(spark, sf).select(
        "clip_id",
        "vec_id",
        "sample_no",
        F.col("sample_no").cast("int").alias("frame_no"),
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        to_gray(byte, F.lit("GRAY")).alias("gray"),
    )


def colours(embedding: Column) -> Column:
    """A pixel of three bytes for every vector element: its thousandths, ten- and hundred-thousandths."""
    bytes_of = F.transform(
        embedding,
        lambda x: F.array(
            *[F.pmod(F.floor(x.cast("double") * k), F.lit(256)).cast("int") for k in (1_000, 10_000, 100_000)]
        ),
    )
    return F.flatten(bytes_of)


def gray_store(spark: SparkSession, sf: str) -> str:
    """The gray frames as a frame store, newly written."""
    path = scratch_path(spark, "gray-store")
    frames = gray_frames(spark, sf).select(
        "clip_id", "frame_no", "height", "width", F.lit("GRAY").alias("channels"), F.col("gray").alias("pixels")
    )
    write_frame_store(frames, path)
    return path


def gray_meta(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "embeddings")
        .groupBy(F.col("label").alias("clip_id"))
        .agg(F.count(F.lit(1)).cast("int").alias("total_frames"))
        .withColumn("height", F.lit(8))
    )


def flows(spark: SparkSession, sf: str) -> DataFrame:
    """8 x 8 flow maps: a vector as u, half of it reversed as v."""
    return table(spark, sf, "embeddings").select(
        F.col("label").alias("clip_id"),
        F.col("vec_id").alias("pair_no"),
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.col("embedding").alias("u"),
        F.transform(F.reverse("embedding"), lambda x: (x * F.lit(0.5)).cast("float")).alias("v"),
    )


def tracks(spark: SparkSession, sf: str) -> DataFrame:
    """Three tracked points per clip; an error loses the point."""
    return events(spark, sf).select(
        F.col("user_id").alias("clip_id"),
        F.col("event_id").alias("pair_no"),
        F.pmod("event_id", F.lit(3)).cast("int").alias("point_id"),
        F.lit(0.0).alias("x0"),
        F.lit(0.0).alias("y0"),
        F.col("value").alias("x1"),
        (F.col("value") / 2).alias("y1"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("status"),
    )


def event_parts(spark: SparkSession, sf: str, parts: int = 6, repeats: bool = False) -> str:
    """All events in files of equal spans of time, to be read as a stream of that many batches.

    With ``repeats``, every seventh event arrives once more, two parts later.
    """
    rows = events(spark, sf)
    ends = rows.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    low, high = (F.unix_micros(F.lit(t)) for t in ends)
    part = F.floor((F.unix_micros("ts") - low) * parts / (high - low + 1)).cast("int")
    dealt = rows.withColumn("part", part)
    if repeats:
        again = dealt.where(F.pmod("event_id", F.lit(7)) == 0)
        dealt = dealt.unionByName(again.withColumn("part", F.pmod(F.col("part") + 2, F.lit(parts))))
    path = scratch_path(spark, "event-parts")
    dealt.repartition(parts, "part").write.partitionBy("part").parquet(path)
    return f"{path}/part=*"


def vote_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Every 26 events of a user, in order of time, are a clip that answers its questions; a click is a yes."""
    rows = event_frames(spark, sf)
    return rows.select(
        F.concat_ws("-", "clip_id", F.floor(F.col("sample_no") / 26)).alias("clip_id"),
        (F.pmod("sample_no", F.lit(26)) + 3).cast("int").alias("q_idx"),
        F.when(F.col("label") == "click", "yes").otherwise(F.col("label")).alias("answer"),
    )


def safety_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as frames of their source, labelled by the toxic flag; without a label they are "unknown"."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    flags = table(spark, sf, "labels").select("doc_id", "toxic")
    return docs.join(flags, "doc_id", "left").select(
        F.col("source").alias("clip_id"),
        F.col("doc_id").alias("sample_no"),
        F.format_string("%d.jpg", F.col("doc_id")).alias("file"),
        F.when(F.col("toxic") == 1, "nsfw").when(F.col("toxic") == 0, "normal").otherwise("unknown").alias("label"),
    )


def source_clips(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("source").alias("clip_id")).distinct()


def prompt_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as answers: ten conversations a clip, a conversation a frame."""
    text = F.when(F.col("role") == "assistant", F.concat("text", F.lit(" <pad><pad>"))).otherwise(
        F.col("text")
    )
    return table(spark, sf, "conversations").select(
        F.floor(F.col("conv_id") / 10).cast("bigint").alias("clip_id"),
        F.col("conv_id").alias("frame_no"),
        F.col("turn").cast("int").alias("p_idx"),
        F.create_map(F.lit("answer"), text).alias("answer"),
    )


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as a catalog: the host is the title, the address the link."""
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("ord"),
        F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("yt_clip_title"),
        F.col("url").alias("yt_clip_link"),
    )


def image_paths(spark: SparkSession, sf: str) -> DataFrame:
    """A file per document under its source; every fourth is not an image."""
    suffix = F.element_at(
        F.array(*[F.lit(x) for x in ("jpg", "PNG", "txt", "webp")]), (F.pmod("doc_id", F.lit(4)) + 1).cast("int")
    )
    return table(spark, sf, "documents").select(
        F.concat(F.lit("/frames/"), "source", F.format_string("/%012d.", F.col("doc_id")), suffix).alias("path")
    )


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as handled items of three metrics; value is the time taken in seconds."""
    return events(spark, sf).select(
        F.concat(F.lit("m"), F.pmod("user_id", F.lit(3))).alias("metric"),
        F.col("user_id").cast("string").alias("video_id"),
        F.col("event_id").alias("seq"),
        F.timestamp_micros(F.unix_micros("ts") - F.floor(F.col("value") * 1000000).cast("bigint")).alias("started"),
        F.col("ts").alias("finished"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("failed with "), F.repeat("props", 12))).alias("error"),
    )
