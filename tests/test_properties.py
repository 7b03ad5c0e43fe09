"""What must hold for any data: bounds, and the same answer from any partitioning."""

import random

import pytest
from pyspark.sql import functions as F

import query_set
from reelmeter.functions.frames import bright_share
from reelmeter.operators import cropping, metrics, sampling
from reelmeter.sources.files import default_questions, drop_prompt_questions
from test_pixels import gray_table, pattern

SF = "/root/testdata/sf0.001"
PARTITIONED = [
    "dense_index_segmented", "sample_nearest_second", "frame_pairs", "aesthetics", "subjects", "track_motion",
    "checkpoint_windows_segmented", "sample_dir_stride", "merge_results", "vision_reward", "block_flow",
]


def rows(df):
    columns = sorted(df.columns)
    return sorted(map(str, df.select(columns).collect()))


@pytest.mark.parametrize("name", PARTITIONED)
def test_partition_counts_do_not_matter(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for partitions in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got.append(rows(query_set.QUERIES[name](spark, SF)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1] and got[0]


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(11)
    clips = [(f"c{i}", rng.choice([0.5, 1.0, 7.3, 23.976, 25.0, 60.0]), rng.randrange(0, 3000)) for i in range(200)]
    return spark.createDataFrame(clips, "clip_id string, fps double, total_frames int")


@pytest.mark.parametrize("desired", [None, 0.3, 7, 90])
def test_samples_stay_inside_clips(many, desired):
    for samples in (
        sampling.sample_uniform(many, desired),
        sampling.sample_uniform(many, desired, discard_last=2.5),
        sampling.sample_timestamped(many, desired),
        sampling.sample_linspace(many, 24, cap_to_total=False),
    ):
        outside = samples.join(many, "clip_id").where("frame_no < 0 or frame_no >= total_frames")
        assert outside.count() == 0 and samples.count() > 0


def test_discarding_takes_a_prefix(many):
    cut = sampling.sample_uniform(many, 4, discard_last=3.0)
    whole = sampling.sample_uniform(many, 4)
    assert cut.exceptAll(whole).count() == 0
    counts = cut.groupBy("clip_id").agg((F.count("*") - F.max("sample_no")).alias("gap"))
    assert counts.where("gap != 1").count() == 0


def test_trim_never_adds_frames(many):
    plan = sampling.trim_plan(many, 7).join(many, "clip_id")
    assert plan.where("frames_to_keep < 0 or frames_to_keep > total_frames").count() == 0


def test_median_lies_between_lines(spark):
    rng = random.Random(4)
    frames = {
        (f"c{c}", n): pattern(c, n, 3, (rng.randrange(0, 12), rng.randrange(0, 14))) for c in range(5) for n in range(9)
    }
    table = gray_table(spark, frames)
    crops = cropping.frame_crop(cropping.row_brightness(table)).cache()
    ends = crops.groupBy("clip_id").agg(
        *[f(side).alias(f"{side}_{f.__name__}") for side in ("top_crop", "bottom_crop") for f in (F.min, F.max)]
    )
    joined = cropping.median_crop(crops).join(ends, "clip_id")
    for side in ("top_crop", "bottom_crop"):
        assert joined.where(f"{side} < {side}_min or {side} > {side}_max").count() == 0
    assert joined.count() == 5
    bright = table.select("height", "width", bright_share(F.col("gray"), F.col("height"), F.col("width")).alias("b"))
    assert bright.where("size(b) != height or array_max(b) > width or array_min(b) < 0").count() == 0


def test_reward_is_bounded(spark):
    rng = random.Random(8)
    votes = [(c, 3 + q, rng.choice(["yes", "no", "", "Yes"])) for c in range(80) for q in range(26)]
    table = spark.createDataFrame(votes, "clip_id int, q_idx int, answer string")
    got = metrics.vision_reward(table, drop_prompt_questions(default_questions(spark)))
    assert got.where("abs(avg_vision_reward) > 0.151099 or size(frame_wise_rewards) != 26").count() == 0
    assert got.count() == 80
