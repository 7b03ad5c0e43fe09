"""Every operator as a named query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import stand_ins as s
from reelmeter.functions import text, vectors, video
from reelmeter.functions.frames import black_region, crop_boundary, to_gray
from reelmeter.operators import balance, cropping, metrics, motion, ordering, runlog, sampling, scoring
from reelmeter.plans import chunks
from reelmeter.plans.runs import Model
from reelmeter.session import scratch_path, task_count
from reelmeter.sources import files, frame_store, results
from reelmeter.streaming import runs as streams
from reelmeter.streaming.seen import SeenIds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__.removesuffix("_")] = fn
    return fn


def r6(name: str) -> Column:
    return F.round(name, 6).alias(name)


# ---- names, ids, manifests -------------------------------------------------


@query
def clean_title(spark, sf):
    return s.table(spark, sf, "pages").select("page_id", text.clean_title(F.col("url")).alias("clean_title"))


@query
def scene_id(spark, sf):
    clean = text.clean_title(F.col("url"))
    return s.table(spark, sf, "pages").select("page_id", text.scene_id(F.col("url"), clean).alias("video_id"))


@query
def url_video_id(spark, sf):
    return s.table(spark, sf, "pages").select(
        "page_id", text.url_video_id(F.col("url"), "?page=").alias("video_id")
    )


@query
def first_link(spark, sf):
    return results.first_links(s.catalog(spark, sf))


@query
def scene_manifest(spark, sf):
    """Titles are addresses; each has one to three scene files."""
    pages = s.table(spark, sf, "pages")
    titles = pages.select(F.col("url").alias("yt_clip_title"))
    scenes = F.explode(F.sequence(F.lit(0), F.pmod("page_id", F.lit(3)).cast("int")))
    listing = pages.select(text.clean_title(F.col("url")).alias("clean_title"), scenes.alias("k")).select(
        "clean_title",
        F.format_string("/scenes/%s/scene_%03d.x.mp4", "clean_title", "k").alias("path"),
    )
    return files.scene_manifest(titles, listing)


@query
def title_collisions(spark, sf):
    """Part names with a blank or an underscore collide once cleaned."""
    names = s.table(spark, sf, "part").select("p_name")
    both = names.union(names.select(F.replace("p_name", F.lit(" "), F.lit(".")).alias("p_name")))
    return files.title_collisions(both, "p_name")


@query
def image_files(spark, sf):
    return files.image_files(s.image_paths(spark, sf)).select("clip_id", "frame_no", "path")


@query
def global_index(spark, sf):
    return ordering.global_index(s.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


@query
def range_slice(spark, sf):
    orders = s.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ordering.range_slice(orders, ["o_orderkey"], 500, 10_000)


@query
def range_slice_selected(spark, sf):
    """A slice by price and key, its ends found by counting."""
    orders = s.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ordering.range_slice(orders, ["o_totalprice", "o_orderkey"], 300)


@query
def seeded_shuffle(spark, sf):
    shuffled = ordering.seeded_shuffle(s.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
    return ordering.global_index(shuffled, ["shuffle_key", "o_orderkey"], "position")


@query
def skip_processed(spark, sf):
    orders = s.table(spark, sf, "orders").select(F.col("o_orderkey").alias("video_id"), "o_totalprice")
    lines = s.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("video_id"))
    return results.skip_processed(orders, lines)


@query
def limit_run(spark, sf):
    return ordering.limit_run(s.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query
def merge_results(spark, sf):
    """Finished orders are stored; all orders come anew."""
    orders = s.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("video_id"), F.col("o_totalprice").alias("score"), "o_orderstatus"
    )
    old = orders.where("o_orderstatus = 'F'").drop("o_orderstatus")
    new = orders.select("video_id", (F.col("score") + 1).alias("score"))
    return results.merge_results(old, new)


@query
def dense_index(spark, sf):
    return s.event_frames(spark, sf).select("clip_id", "event_id", "sample_no")


@query
def dense_index_segmented(spark, sf):
    """The same through range partitions, as for clips too long for one task."""
    rows = s.events(spark, sf).select(F.col("user_id").alias("clip_id"), "ts", "event_id")
    return ordering.dense_index(rows, ["clip_id"], ["ts", "event_id"], max_group_rows=0).drop("ts")


# ---- metadata and sampling -------------------------------------------------


@query
def video_info(spark, sf):
    info = video.video_info(s.part_meta(spark, sf)).drop("error")
    return info.withColumn("duration_seconds", F.round("duration_seconds", 6))


@query
def fit_dims(spark, sf):
    fit = video.fit_dims(F.col("width"), F.col("height"), 512, 288)
    return s.part_meta(spark, sf).select("clip_id", fit.alias("d")).select("clip_id", "d.width", "d.height")


@query
def trim_plan(spark, sf):
    return sampling.trim_plan(s.part_meta(spark, sf), 40)


@query
def trim_summary(spark, sf):
    return sampling.trim_summary(sampling.trim_plan(s.part_meta(spark, sf), 40))


@query
def apply_trim(spark, sf):
    plan = sampling.trim_plan(s.event_meta(spark, sf), 25)
    frames = s.event_frames(spark, sf).select("clip_id", F.col("sample_no").alias("frame_no"), "score")
    return sampling.apply_trim(frames, plan)


@query
def sample_uniform(spark, sf):
    return sampling.sample_uniform(s.part_meta(spark, sf))


@query
def sample_uniform_fps(spark, sf):
    """A step that does not add exactly (1/10 s), summed up per clip."""
    samples = sampling.sample_uniform(s.part_meta(spark, sf), desired_fps=10)
    return samples.groupBy("clip_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("frame_no").cast("bigint")).alias("sum_frames"),
        F.sum(F.col("frame_no") * (F.col("sample_no") + 1)).alias("weighted_frames"),
    )


@query
def sample_uniform_discard(spark, sf):
    return sampling.sample_uniform(s.part_meta(spark, sf), discard_last=30)


@query
def sample_timestamped(spark, sf):
    return sampling.sample_timestamped(s.part_meta(spark, sf), desired_fps=2)


@query
def fetch_frames(spark, sf):
    frames = s.event_frames(spark, sf).select("clip_id", F.col("sample_no").alias("frame_no"), "score")
    samples = sampling.sample_uniform(s.event_meta(spark, sf))
    return sampling.fetch_frames(samples.select("clip_id", "sample_no", "frame_no"), frames)


@query
def sample_frames(spark, sf):
    """The same frames chosen row by row, without a join on frame numbers."""
    frames = s.event_frames(spark, sf).select("clip_id", F.col("sample_no").alias("frame_no"), "score")
    return sampling.sample_frames(frames, s.event_meta(spark, sf)).drop("t_s")


@query
def sample_frames_fps(spark, sf):
    """Frames chosen row by row at rates whose steps do not add exactly."""
    frames = s.event_frames(spark, sf).select("clip_id", F.col("sample_no").alias("frame_no"), "score")
    found = [
        sampling.sample_frames(frames, s.event_meta(spark, sf), desired_fps=fps).select(
            F.lit(fps).alias("fps"), "clip_id", "sample_no", "frame_no", F.round("t_s", 9).alias("t_s")
        )
        for fps in (3, 10, 24, 30)
    ]
    return found[0].union(found[1]).union(found[2]).union(found[3])


@query
def keyframes(spark, sf):
    index = s.events(spark, sf).select(
        F.col("user_id").alias("clip_id"),
        F.col("event_id").alias("frame_no"),
        (F.col("event_type") == "view").alias("is_key"),
    )
    return sampling.keyframes(index)


@query
def stride(spark, sf):
    return sampling.stride(s.event_frames(spark, sf).select("clip_id", "sample_no", "score"), 3)


@query
def sample_linspace(spark, sf):
    return sampling.sample_linspace(s.part_meta(spark, sf), 5)


@query
def sample_linspace_repeat(spark, sf):
    return sampling.sample_linspace(s.part_sizes(spark, sf), 24, cap_to_total=False)


@query
def sample_nearest_second(spark, sf):
    return sampling.sample_nearest_second(s.event_times(spark, sf))


@query
def sample_dir_stride(spark, sf):
    return sampling.sample_dir_stride(files.image_files(s.image_paths(spark, sf)).drop("frame_no"))


# ---- pixels and motion -----------------------------------------------------

# Vectors are mid-gray: half brightness and wider steps reach every branch.
RULES = {"darkness": 127, "black_ratio": 0.5, "bright_ratio": 0.5, "scan": (12.5, 50.0, 12.5)}
FRAME_RULES = {k: v for k, v in RULES.items() if k != "darkness"}


def _bright(spark, sf):
    return cropping.row_brightness(s.gray_frames(spark, sf), RULES["darkness"])


@query
def to_gray_(spark, sf):
    return s.table(spark, sf, "embeddings").select(
        "vec_id", F.hex(to_gray(s.colours(F.col("embedding")), F.lit("BGR"))).alias("gray")
    )


@query
def black_region_(spark, sf):
    args = F.col("bright"), F.col("height"), F.col("width")
    return _bright(spark, sf).select(
        "clip_id", "frame_no",
        black_region(*args, "top", 30.0, 0.5).alias("top"),
        black_region(*args, "bottom", 30.0, 0.5).alias("bottom"),
    )


@query
def crop_boundary_(spark, sf):
    args = F.col("bright"), F.col("height"), F.col("width")
    return _bright(spark, sf).select(
        "clip_id", "frame_no",
        crop_boundary(*args, "top", 0.5, RULES["scan"]).alias("top"),
        crop_boundary(*args, "bottom", 0.5, RULES["scan"]).alias("bottom"),
    )


@query
def frame_crop(spark, sf):
    return cropping.frame_crop(_bright(spark, sf), simple_percent=30.0, **FRAME_RULES).select(
        "clip_id", "frame_no", "top_crop", "bottom_crop"
    )


@query
def median_crop(spark, sf):
    crops = cropping.frame_crop(_bright(spark, sf), **FRAME_RULES)
    return cropping.median_crop(crops).drop("height")


@query
def clip_crop_plan(spark, sf):
    return cropping.clip_crop_plan(s.gray_meta(spark, sf), s.gray_frames(spark, sf), **RULES)


def _pixel_frames(spark, sf):
    return s.gray_frames(spark, sf).withColumn("pixels", F.col("gray"))


@query
def apply_crop(spark, sf):
    frames = _pixel_frames(spark, sf)
    plan = cropping.clip_crop_plan(s.gray_meta(spark, sf), frames, **RULES)
    return cropping.apply_crop(frames, plan, depth=1).select(
        "clip_id", "frame_no", "height", F.hex("pixels").alias("pixels")
    )


@query
def crop_clips(spark, sf):
    cropped = cropping.crop_clips(
        s.gray_meta(spark, sf), _pixel_frames(spark, sf), bottom_percent=30.0, smart=False, depth=1, **RULES
    )
    return cropped.select("clip_id", "frame_no", "height", F.hex("pixels").alias("pixels"))


def _store(spark, sf):
    path = s.gray_store(spark, sf)
    return path, frame_store.frame_index(spark, path)


def _hexed(frames, *columns):
    return frames.select("clip_id", *columns, F.hex("pixels").alias("pixels"))


@query
def stored_frames(spark, sf):
    """Frames of a store at a time step of a second: only theirs are read."""
    path, index = _store(spark, sf)
    chosen = sampling.sample_frames(index, s.gray_meta(spark, sf).withColumn("fps", F.lit(2.0)))
    return _hexed(frame_store.read_pixels(chosen, path), "sample_no", "frame_no")


@query
def stored_trim(spark, sf):
    path, index = _store(spark, sf)
    plan = sampling.trim_plan(s.gray_meta(spark, sf).withColumn("fps", F.lit(2.0)), 3)
    return _hexed(frame_store.read_pixels(sampling.apply_trim(index, plan), path), "frame_no")


@query
def stored_crop(spark, sf):
    """Plan and crop of a store: five frames a clip are read for the plan, then the rows that stay."""
    path, index = _store(spark, sf)
    plan = cropping.clip_crop_plan(
        s.gray_meta(spark, sf), index, fetch=lambda rows: frame_store.read_pixels(rows, path), **RULES
    )
    kept = frame_store.crop_places(index, plan, depth=1)
    return _hexed(frame_store.read_pixels(kept, path), "frame_no", "height")


@query
def frame_store_scan(spark, sf):
    """The store as a data source, in two reads with filters that it takes over."""
    path = s.gray_store(spark, sf)
    early = frame_store.read_frame_store(spark, path).where("frame_no < 16")
    late = frame_store.read_frame_store(spark, path).where("frame_no >= 16")
    both = early.withColumn("part", F.lit("early")).union(late.withColumn("part", F.lit("late")))
    return _hexed(both, "frame_no", "height", "width", "part")


@query
def frame_pairs(spark, sf):
    return motion.frame_pairs(s.event_frames(spark, sf), payload=("score",))


@query
def block_flow(spark, sf):
    pairs = motion.frame_pairs(s.gray_frames(spark, sf), keep=("height", "width"))
    return motion.block_flow(pairs, block=4).select("clip_id", "pair_no", "block", r6("u"), r6("v"))


@query
def flow_plug_in(spark, sf):
    """A solver plug-in: here the plain difference of the two frames, in both directions."""
    pairs = motion.frame_pairs(s.gray_frames(spark, sf), keep=("height", "width"))

    def difference(before: np.ndarray, after: np.ndarray):
        d = after.astype(np.float32) - before.astype(np.float32)
        return d, -d

    flow = motion.dense_flow(pairs, difference)
    return flow.select("clip_id", "pair_no", F.posexplode(F.arrays_zip("u", "v")).alias("cell", "p")).select(
        "clip_id", "pair_no", "cell", F.col("p.u").cast("double").alias("u"), F.col("p.v").cast("double").alias("v")
    )


@query
def flow_polar(spark, sf):
    polar = motion.flow_polar(s.flows(spark, sf))
    return polar.select(
        "clip_id", "pair_no", F.posexplode(F.arrays_zip("magnitude", "angle")).alias("cell", "p")
    ).select(
        "clip_id", "pair_no", "cell",
        F.round("p.magnitude", 6).alias("magnitude"), F.round("p.angle", 6).alias("angle"),
    )


@query
def downscale_flow(spark, sf):
    small = motion.downscale_flow(s.flows(spark, sf), width=4)
    return small.select(
        "clip_id", "pair_no", "height", "width", F.posexplode(F.arrays_zip("u", "v")).alias("cell", "p")
    ).select(
        "clip_id", "pair_no", "height", "width", "cell",
        F.round(F.col("p.u").cast("double"), 6).alias("u"), F.round(F.col("p.v").cast("double"), 6).alias("v"),
    )


@query
def motion_score(spark, sf):
    clips = s.event_clips(spark, sf).select(F.col("clip_id").cast("int"))
    return motion.motion_score(clips, s.flows(spark, sf)).select("clip_id", r6("motion_flow"))


@query
def track_motion(spark, sf):
    return motion.track_motion(s.event_clips(spark, sf), s.tracks(spark, sf)).select("clip_id", r6("motion_tracks"))


# ---- heads and scoring -----------------------------------------------------


@query
def aesthetic_head(spark, sf):
    weights = [i / 64 for i in range(64)]
    score = vectors.aesthetic_head(F.col("embedding"), weights, 5.0)
    return s.table(spark, sf, "embeddings").select("vec_id", F.round(score, 6).alias("score"))


# The 64 elements to three hidden units to two outputs.
LAYERS = (
    (np.array([[((7 * j + 3 * h) % 11 - 5) / 4 for j in range(64)] for h in range(3)]), np.array([0.1, -0.2, 0.3])),
    (np.array([[2.0, -1.0, 0.5], [-0.5, 1.0, 1.5]]), np.array([0.05, -0.05])),
)


def _watermark_scores(spark, sf):
    return s.embedding_frames(spark, sf).select(
        "clip_id", "vec_id", "sample_no",
        F.format_string("%d.jpg", "vec_id").alias("file"),
        vectors.watermark_head(F.col("embedding"), LAYERS).alias("score"),
    )


@query
def watermark_head(spark, sf):
    return _watermark_scores(spark, sf).select("vec_id", r6("score"))


@query
def argmax_label(spark, sf):
    label = vectors.argmax_label(F.col("embedding"), [f"label{i}" for i in range(64)])
    return s.table(spark, sf, "embeddings").select("vec_id", label.alias("label"))


@query
def image_normalise(spark, sf):
    scaled = vectors.image_normalise(s.colours(F.col("embedding")))
    return (
        s.table(spark, sf, "embeddings")
        .select("vec_id", scaled.alias("x"))
        .select("vec_id", F.posexplode("x").alias("pos", "x"))
        .select("vec_id", "pos", F.round(F.col("x").cast("double"), 4).alias("x"))
    )


@query
def score_batches(spark, sf):
    """A plug-in over text items; it refuses one language, one item to a batch."""

    def infer(model, batch):
        if (batch["lang"] == model["refused"]).any():
            raise ValueError("language not supported")
        return [{"score": float(len(t))} for t in batch["text"]]

    scored = scoring.score_batches(
        s.table(spark, sf, "documents").select("doc_id", "lang", "text"),
        lambda: {"refused": "fr"}, infer, "struct<score:double>", ["doc_id"], 1, task_count(spark),
    )
    return scored.select("doc_id", F.col("result.score").alias("score"), "error")


@query
def score_by_cost(spark, sf):
    """Documents in batches of up to 64, in sixteen tasks of about equal length."""

    def infer(model, batch):
        return [{"score": float(len(t))} for t in batch["text"]]

    docs = s.table(spark, sf, "documents").select("doc_id", "n_chars", "text")
    scored = balance.score_by_cost(docs, "n_chars", 16, lambda: None, infer, "struct<score:double>", ["doc_id"], 64)
    return scored.select("doc_id", F.col("result.score").alias("score"), "error")


@query
def cost_balance(spark, sf):
    """Whether tasks of the same documents, and of them with one that is a third of all, are balanced."""
    docs = s.table(spark, sf, "documents").select("doc_id", "n_chars")
    third = docs.agg(F.lit(-1).cast("bigint").alias("doc_id"), F.floor(F.sum("n_chars") / 2).alias("n_chars"))
    out = []
    for kind, rows in (("even", docs), ("hot", docs.unionByName(third))):
        found = balance.balance(balance.deal_by_cost(rows, "n_chars", 16, "doc_id"), "n_chars")
        even = F.col("largest_task") <= F.greatest(1.5 * F.col("cost") / 16, F.col("largest_clip"))
        out.append(found.select(F.lit(kind).alias("kind"), "rows", F.col("cost").cast("bigint").alias("cost"), even.alias("balanced")))
    return out[0].union(out[1])


@query
def error_rows(spark, sf):
    """Failures of single-item batches, kept apart from results."""

    def infer(model, batch):
        if (batch["toxic"] == 1).any():
            raise ValueError("refused")
        return [{"score": 1.0}] * len(batch)

    scored = scoring.score_batches(
        s.table(spark, sf, "labels"), lambda: None, infer,
        "struct<score:double>", ["doc_id"], 1, task_count(spark),
    )
    return scoring.error_rows(scored).select("doc_id", "error")


@query
def prompt_fanout(spark, sf):
    frames = s.table(spark, sf, "documents").select("doc_id")
    return scoring.prompt_fanout(frames, files.shot_prompts(spark))


@query
def question_fanout(spark, sf):
    questions = files.drop_prompt_questions(files.default_questions(spark))
    return scoring.question_fanout(s.event_clips(spark, sf), questions)


# ---- clip metrics ----------------------------------------------------------


@query
def avg_aesthetic(spark, sf):
    scores = s.events(spark, sf).select(F.col("user_id").alias("clip_id"), F.col("value").alias("score"))
    return metrics.avg_aesthetic(s.event_clips(spark, sf), scores).select("clip_id", r6("avg_aesthetic_score"))


@query
def aesthetics(spark, sf):
    """Averages and per-frame maps, unfolded to a row per frame; short parts to see several."""
    result = metrics.aesthetics(s.event_clips(spark, sf), s.event_frames(spark, sf), part_frames=16)
    return result.select(
        "clip_id", "part_no", r6("avg_aesthetic_score"),
        F.explode_outer("frame_aesthetic_scores").alias("frame", "score"),
    )


@query
def nsfw_share(spark, sf):
    return metrics.nsfw_share(s.source_clips(spark, sf), s.safety_labels(spark, sf)).select(
        "clip_id", r6("avg_nsfw_score")
    )


@query
def nsfw(spark, sf):
    result = metrics.nsfw(s.source_clips(spark, sf), s.safety_labels(spark, sf))
    return result.select(
        "clip_id", r6("avg_nsfw_score"), F.explode_outer("frame_nsfw_results").alias("file", "label")
    )


@query
def watermark_avg(spark, sf):
    clips = s.event_clips(spark, sf).select(F.col("clip_id").cast("int"))
    return metrics.watermark_avg(clips, _watermark_scores(spark, sf)).select("clip_id", r6("avg_watermark_score"))


@query
def watermark(spark, sf):
    clips = s.embedding_frames(spark, sf).select("clip_id").distinct()
    result = metrics.watermark(clips, _watermark_scores(spark, sf))
    return result.select(
        "clip_id", r6("avg_watermark_score"), F.explode("frame_watermark_results").alias("file", "score")
    ).withColumn("score", F.round("score", 6))


@query
def confidence_filter(spark, sf):
    return metrics.confidence_filter(s.detections(spark, sf)).select("clip_id", "frame_no", "label", "conf")


@query
def part_bucket(spark, sf):
    return s.table(spark, sf, "part").select(
        "p_partkey", text.bucket(F.col("p_name"), s.PART_BUCKETS).alias("bucket")
    )


@query
def subject_bucket(spark, sf):
    """The fixed buckets over whole texts taken as labels."""
    return s.table(spark, sf, "documents").select("doc_id", text.bucket(F.col("text")).alias("bucket"))


def _detected(spark, sf):
    return s.detection_frames(spark, sf), metrics.confidence_filter(s.detections(spark, sf))


@query
def raw_counts(spark, sf):
    counts = metrics.raw_counts(*_detected(spark, sf))
    return counts.select("clip_id", "frame_no", F.explode("raw_counts").alias("label", "n"))


@query
def bucketed_counts(spark, sf):
    return metrics.bucketed_counts(*_detected(spark, sf), s.PART_BUCKETS)


@query
def subject_averages(spark, sf):
    frames, detected = _detected(spark, sf)
    averages = metrics.subject_averages(
        s.event_clips(spark, sf), frames, detected, s.PART_BUCKETS, ("warm", "cool")
    )
    return averages.select("clip_id", r6("avg_subjects"), r6("avg_warm"), r6("avg_cool"))


@query
def subjects(spark, sf):
    frames, detected = _detected(spark, sf)
    frames = frames.withColumn("frame_no", F.col("frame_no").cast("int"))
    detected = detected.withColumn("frame_no", F.col("frame_no").cast("int"))
    result = metrics.subjects(s.event_clips(spark, sf), frames, detected)
    return result.select(
        "clip_id", r6("avg_subjects"), r6("avg_humans"), r6("avg_animals"),
        F.explode_outer("frame_counts").alias("frame_no", "c"),
    ).select(
        "clip_id", "avg_subjects", "avg_humans", "avg_animals", "frame_no",
        F.col("c.raw_counts")["total"].alias("raw_total"),
        F.col("c.bucketed_counts.others").alias("others"),
        F.col("c.bucketed_counts.total").alias("total"),
    )


@query
def strip_pad(spark, sf):
    return s.prompt_answers(spark, sf).select(
        "frame_no", "p_idx", F.md5(text.strip_pad(F.col("answer"))["answer"]).alias("answer")
    )


@query
def shot_categories(spark, sf):
    clips = s.event_clips(spark, sf)
    result = metrics.shot_categories(clips, s.prompt_answers(spark, sf))
    return (
        result.select("clip_id", F.explode_outer("frame_shot_categorization").alias("frame_no", "answers"))
        .select("clip_id", "frame_no", F.posexplode_outer("answers").alias("pos", "a"))
        .select("clip_id", "frame_no", "pos", F.md5(F.col("a")["answer"]).alias("answer"))
    )


@query
def vision_reward(spark, sf):
    questions = files.drop_prompt_questions(files.default_questions(spark))
    votes = metrics.vision_reward(s.vote_answers(spark, sf), questions)
    return votes.select(
        "clip_id", F.round("avg_vision_reward", 9).alias("avg_vision_reward"),
        F.array_join(F.col("frame_wise_rewards").cast("array<string>"), ",").alias("signs"),
    )


# ---- runs ------------------------------------------------------------------


@query
def run_summary(spark, sf):
    summary = runlog.run_summary(s.run_log(spark, sf), workers=4)
    return summary.select("metric", "processed", *[r6(c) for c in summary.columns[2:]])


@query
def checkpoint_windows(spark, sf):
    windows = runlog.checkpoint_windows(s.run_log(spark, sf), every=50)
    return windows.select("metric", "window_no", "items", "successes", *[r6(c) for c in windows.columns[4:]])


@query
def checkpoint_windows_segmented(spark, sf):
    """The same through range partitions: a metric is one group of many rows."""
    windows = runlog.checkpoint_windows(s.run_log(spark, sf), every=50, max_group_rows=0)
    return windows.select("metric", "window_no", "items", "successes", *[r6(c) for c in windows.columns[4:]])


@query
def error_summary(spark, sf):
    return runlog.error_summary(s.run_log(spark, sf))


@query
def metric_timing(spark, sf):
    return runlog.metric_timing(s.run_log(spark, sf)).select("metric", r6("seconds"), r6("mean_seconds"))


@query
def resumed_run(spark, sf):
    """Even clips stored by one run, the rest by a second one that skips them."""
    root = scratch_path(spark, "resumed-run")
    clips = s.event_clips(spark, sf).withColumnRenamed("clip_id", "video_id")
    scores = s.events(spark, sf).select(F.col("user_id").alias("clip_id"), F.col("value").alias("score"))
    first = clips.where(F.pmod("video_id", F.lit(2)) == 0)
    for run_id, wanted in (("1", first), ("2", clips)):
        left = results.skip_processed(wanted, results.read_other_runs(spark, root, "aesthetics", run_id))
        means = metrics.avg_aesthetic(left.withColumnRenamed("video_id", "clip_id"), scores)
        results.write_results(means.withColumnRenamed("clip_id", "video_id"), root, "aesthetics", run_id)
    stored = results.read_results(spark, root, "aesthetics")
    return stored.select("video_id", r6("avg_aesthetic_score"), F.col("run_id"))


@query
def resumed_chunks(spark, sf):
    """A run in five chunks, ended after two and taken up again; frames scored per clip are counted."""
    root = scratch_path(spark, "resumed-chunks")
    clips = s.event_clips(spark, sf).withColumnRenamed("clip_id", "video_id")
    scores = s.event_frames(spark, sf).select("clip_id", "sample_no", "score")
    model = Model(lambda: None, lambda _, batch: [{"score": x} for x in batch["score"]], 4096)

    def frames(left):
        return scores.join(left.select(F.col("video_id").alias("clip_id")), "clip_id", "left_semi")

    size = clips.count() // 5 + 1
    for most in (2, None):
        chunks.run_chunked(spark, "aesthetics", clips, root, "1", model, frames, size, most)
    found = chunks.committed_results(spark, root, "aesthetics", "1")
    counts = results.read_scored(spark, f"{root}/scored", "aesthetics").groupBy("clip_id").agg(F.count(F.lit(1)).alias("n"))
    return found.groupBy("video_id", "chunk_no").agg(F.max(r6("avg_aesthetic_score")).alias("score")).join(
        counts, F.col("video_id") == F.col("clip_id"), "left"
    ).select("video_id", "chunk_no", "score", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_scored"))


# ---- streams ---------------------------------------------------------------


def _event_stream(spark, sf):
    # a pattern, since the stream source takes a single file only through one
    stream = streams.file_stream(
        spark, f"{sf}/events*.parquet", s.table(spark, sf, "events").schema
    )
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def score_stream(spark, sf):
    sink, checkpoint = streams.new_run(spark, "score-stream")
    stream = _event_stream(spark, sf).withColumn("video_id", F.col("event_id"))

    def score(batch):
        return batch.select("video_id", (F.col("value") * 2 + 1).alias("score"))

    for _ in range(2):  # the second start finds nothing new
        streams.score_stream(stream, score, sink, checkpoint)
    return spark.read.parquet(sink).select("video_id", r6("score"))


@query
def stream_throughput(spark, sf):
    sink, checkpoint = streams.new_run(spark, "stream-throughput")
    streams.stream_throughput(_event_stream(spark, sf), sink, checkpoint, "ts", "1 day", "40 days")
    return streams.latest_windows(spark, sink).select(F.unix_micros("window_start").alias("window_us"), "items")


@query
def stream_running_mean(spark, sf):
    sink, checkpoint = streams.new_run(spark, "stream-running-mean")
    stream = _event_stream(spark, sf).select(F.col("user_id").alias("clip_id"), F.col("value").alias("score"))
    streams.stream_running_mean(stream, sink, checkpoint)
    return streams.running_means(spark, sink).select("clip_id", "n", r6("mean_score"))


@query
def stream_dedupe(spark, sf):
    sink, checkpoint = streams.new_run(spark, "stream-dedupe")
    stream = _event_stream(spark, sf).select(F.col("user_id").alias("video_id"), "ts")
    streams.stream_dedupe(stream, sink, checkpoint, "ts", "40 days")
    return spark.read.parquet(sink).select("video_id")


def _part_stream(spark, sf, repeats=False):
    """Events in six micro-batches."""
    schema = s.events(spark, sf).schema
    return streams.file_stream(spark, s.event_parts(spark, sf, repeats=repeats), schema, files_per_batch=1)


@query
def score_stream_seen(spark, sf):
    """Six batches in which ids come back; each is scored once, by an index of seen ids."""
    sink, checkpoint = streams.new_run(spark, "score-stream-seen")
    stream = _part_stream(spark, sf, repeats=True).withColumn("video_id", F.col("event_id"))

    def score(batch):
        return batch.select("video_id", (F.col("value") * 2 + 1).alias("score"))

    index = SeenIds(f"{sink}-seen", buckets=16, bits=1 << 17, merge_every=4)
    streams.score_stream_indexed(stream, score, sink, checkpoint, index)
    stored = spark.read.parquet(sink)
    return stored.groupBy("video_id").agg(F.max(r6("score")).alias("score"), F.count(F.lit(1)).alias("times"))


def _totals(means):
    """Means as sums: they are whole hundredths, so that rounding does not depend on the order of addition."""
    return means.select("clip_id", "n", F.round(F.col("mean_score") * F.col("n"), 4).alias("total"))


@query
def stream_mean_state(spark, sf):
    sink, checkpoint = streams.new_run(spark, "stream-mean-state")
    stream = _part_stream(spark, sf).select(F.col("user_id").alias("clip_id"), F.col("value").alias("score"))
    streams.stream_mean_state(stream, sink, checkpoint)
    return _totals(streams.current_means(spark, sink))


@query
def stream_mean_windows(spark, sf):
    """The same with state that leaves by the watermark; files come in any order, so it is a wide one."""
    sink, checkpoint = streams.new_run(spark, "stream-mean-windows")
    stream = _part_stream(spark, sf).select(F.col("user_id").alias("clip_id"), F.col("value").alias("score"), "ts")
    streams.stream_mean_state(stream, sink, checkpoint, time="ts", width="7 days", delay="40 days")
    return _totals(streams.current_means(spark, sink))


@query
def stream_throughput_batches(spark, sf):
    sink, checkpoint = streams.new_run(spark, "stream-throughput-batches")
    streams.stream_throughput(_part_stream(spark, sf), sink, checkpoint, "ts", "1 day", "40 days")
    return streams.latest_windows(spark, sink).select(F.unix_micros("window_start").alias("window_us"), "items")


@query
def stream_dedupe_batches(spark, sf):
    """Ids that come back in later batches."""
    sink, checkpoint = streams.new_run(spark, "stream-dedupe-batches")
    stream = _part_stream(spark, sf, repeats=True).select(F.col("event_id").alias("video_id"), "ts")
    streams.stream_dedupe(stream, sink, checkpoint, "ts", "40 days")
    return spark.read.parquet(sink).select("video_id")
