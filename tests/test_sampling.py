import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelmeter.operators import sampling


def meta(spark, *rows):
    rows = [(f"c{i}", float(fps), total) for i, (fps, total) in enumerate(rows)]
    return spark.createDataFrame(rows, "clip_id string, fps double, total_frames int")


def numbers(df, order="sample_no"):
    return [r.frame_no for r in df.orderBy("clip_id", order).collect()]


@pytest.mark.parametrize(
    "fps, total, desired, discard, want",
    [
        (25, 100, None, None, [0, 25, 50, 75]),
        (29.97, 90, None, None, [0, 30, 60]),
        (2.5, 10, None, None, [0, 2, 5, 8]),
        (2.5, 10, 2, None, [0, 1, 2, 4, 5, 6, 8, 9]),
        (2, 5, 4, None, [0, 0, 1, 2, 2, 2, 3, 4, 4, 4]),
        (0.5, 4, None, None, [0, 0, 1, 2, 2, 2, 3]),
        (0, 10, None, None, []),
        (25, 0, None, None, []),
        (2.5, 10, None, 2, [0, 2, 5]),
    ],
)
def test_sample_uniform(spark, fps, total, desired, discard, want):
    assert numbers(sampling.sample_uniform(meta(spark, (fps, total)), desired, discard)) == want


def walk(fps, total, desired, discard, include_end):
    """The sampling rule one step at a time."""
    step = 1.0 / desired if desired else 1.0
    length = total / fps if fps > 0 else 0
    t, out = 0.0, []
    while t < length or (include_end and t == length):
        if discard is not None and t > length - discard:
            break
        if round(t * fps) >= total:
            break
        out.append((t, round(t * fps)))
        t += step
    return out


@pytest.mark.parametrize("desired", [None, 10, 3, 4, 0.7])
@pytest.mark.parametrize("discard", [None, 1.5])
@pytest.mark.parametrize("include_end", [True, False])
def test_times_equal_stepwise_sampling(spark, desired, discard, include_end):
    rng = random.Random(1)
    clips = [(rng.choice([25, 24, 29.97, 12.5, 5, 0]), rng.randrange(0, 900)) for _ in range(25)]
    got = sampling.sample_times(meta(spark, *clips), desired, discard, include_end).collect()
    for i, (fps, total) in enumerate(clips):
        mine = sorted((r.sample_no, r.t_s, r.frame_no) for r in got if r.clip_id == f"c{i}")
        want = walk(fps, total, desired, discard, include_end)
        assert [(t, f) for _, t, f in mine] == want
        assert [n for n, _, _ in mine] == list(range(len(want)))


@pytest.mark.parametrize("desired", [None, 2, 4, 8, 0.5, 3])
@pytest.mark.parametrize("discard", [None, 1.5])
@pytest.mark.parametrize("size", [0, 1_000_000])
def test_sampling_in_place_equals_join(spark, monkeypatch, desired, discard, size):
    """``size`` 0 takes the salted join instead of the broadcast."""
    monkeypatch.setattr(sampling.attach, "__defaults__", ("inner", True, size))
    rng = random.Random(2)
    clips = [(rng.choice([25, 24, 29.97, 2.5, 1, 0.5, 3, 0]), rng.randrange(0, 120)) for _ in range(30)]
    m = meta(spark, *clips)
    rows = [(f"c{i}", f, f * 1.5) for i, (_, n) in enumerate(clips) for f in range(n + 3) if f % 7 != 5]
    frames = spark.createDataFrame(rows, "clip_id string, frame_no int, x double")
    columns = ["clip_id", "sample_no", "t_s", "frame_no", "x"]
    want = sampling.fetch_frames(sampling.sample_uniform(m, desired, discard), frames)
    got = sampling.sample_frames(frames, m, desired, discard)
    want, got = (sorted(map(tuple, d.select(columns).collect())) for d in (want, got))
    assert got == want and len(got) > 0


def test_repeated_sum_crosses_blocks(spark):
    k = [0, 1, 65535, 65536, 65537, 200_000]
    df = spark.createDataFrame([(i,) for i in k], "k bigint")
    got = [r.t for r in df.select(sampling.repeated_sum(F.col("k"), 0.1).alias("t")).collect()]
    sums = np.cumsum(np.concatenate(([0.0], np.full(200_000, 0.1))))
    assert got == [sums[i] for i in k]


def test_explode_range_of_long_clip(spark):
    df = spark.createDataFrame([("a", 200_000), ("b", 0), ("c", 1)], "clip_id string, n bigint")
    got = sampling.explode_range(df, F.col("n"), "i", spread=True).groupBy("clip_id").agg(
        F.count("i").alias("n"), F.countDistinct("i").alias("d"), F.max("i").alias("m")
    )
    assert {r.clip_id: (r.n, r.d, r.m) for r in got.collect()} == {
        "a": (200_000, 200_000, 199_999), "c": (1, 1, 0),
    }


def test_timestamped_last_of_second_wins_and_unreadable_frames_drop(spark):
    m = meta(spark, (2.5, 10))
    got = {r.label: r.frame_no for r in sampling.sample_timestamped(m, desired_fps=2).collect()}
    assert got == {
        "frame_00:00.png": 1, "frame_00:01.png": 4, "frame_00:02.png": 6, "frame_00:03.png": 9,
    }
    frames = spark.createDataFrame([("c0", 0), ("c0", 2), ("c0", 6)], "clip_id string, frame_no int")
    got = {r.label: r.frame_no for r in sampling.sample_timestamped(m, 2, frames=frames).collect()}
    assert got == {"frame_00:00.png": 0, "frame_00:01.png": 2, "frame_00:02.png": 6}


def test_timestamped_minutes_do_not_wrap(spark):
    labels = [r.label for r in sampling.sample_timestamped(meta(spark, (1, 3700))).collect()]
    assert "frame_61:39.png" in labels and len(labels) == 3700


def test_timestamped_includes_first_frame_without_rate(spark):
    assert numbers(sampling.sample_timestamped(meta(spark, (0, 10))), "label") == [0]


@pytest.mark.parametrize(
    "total, n, cap, want",
    [
        (100, 5, True, [0, 24, 49, 74, 99]),
        (3, 3, True, [0, 1, 2]),
        (3, 5, True, [0, 1, 2]),
        (3, 5, False, [0, 0, 1, 1, 2]),
        (11, 4, True, [0, 3, 6, 10]),
        (1, 1, True, [0]),
        (1, 5, False, [0, 0, 0, 0, 0]),
        (0, 5, True, []),
    ],
)
def test_sample_linspace(spark, total, n, cap, want):
    assert numbers(sampling.sample_linspace(meta(spark, (25, total)), n, cap)) == want


def test_linspace_equals_numpy(spark):
    clips = [(1, total) for total in range(1, 130)]
    for n in (2, 5, 24):
        got = sampling.sample_linspace(meta(spark, *clips), n, cap_to_total=False).collect()
        for i, (_, total) in enumerate(clips):
            mine = [f for _, f in sorted((r.sample_no, r.frame_no) for r in got if r.clip_id == f"c{i}")]
            assert mine == np.linspace(0, total - 1, n, dtype=int).tolist()


def times(spark, *clips):
    rows = [(f"c{c}", i, float(t)) for c, ts in enumerate(clips) for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "clip_id string, frame_no bigint, ts_s double")


@pytest.mark.parametrize(
    "ts, want",
    [
        ([0, 0.4, 0.8, 1.2, 2.5, 3.1], [0, 2, 4, 5]),
        ([0.5, 1.5, 2.5], [0, 0, 1]),
        ([0, 5], [0, 0, 0, 1, 1, 1]),
        ([0, 0.5, 1.5, 1.5, 2.2], [0, 1, 4]),
    ],
)
def test_nearest_second(spark, ts, want):
    assert numbers(sampling.sample_nearest_second(times(spark, ts)), "sec") == want


def test_nearest_second_equals_search(spark):
    rng = random.Random(3)
    clips = [
        sorted(round(rng.uniform(0, span), 2) for _ in range(rng.randrange(1, 60)))
        for span in (0.4, 3, 9, 30, 200, 30, 30)
    ]
    clips.append([100.0, 100.25])  # starts after the last second taken
    clips.append([3.0, 1.0, 2.0, 1.0])  # not in order
    got = sampling.sample_nearest_second(times(spark, *clips).repartition(7)).collect()
    for c, ts in enumerate(clips):
        seconds = range(min(int(max(ts)) + 1, 24))
        want = [min(range(len(ts)), key=lambda i: abs(ts[i] - s)) for s in seconds]
        mine = [f for _, f in sorted((r.sec, r.frame_no) for r in got if r.clip_id == f"c{c}")]
        assert mine == want


@pytest.mark.parametrize("max_group_rows", [0, 1000])
@pytest.mark.parametrize(
    "total, step, count, last", [(5, 1, 5, 4), (24, 1, 24, 23), (47, 1, 24, 23), (48, 2, 24, 46), (100, 4, 24, 92)]
)
def test_dir_stride(spark, total, step, count, last, max_group_rows):
    files = spark.range(total).select(
        F.lit("d").alias("clip_id"), F.format_string("d/%05d.jpg", F.col("id")).alias("path")
    )
    got = sampling.sample_dir_stride(files, max_group_rows=max_group_rows).orderBy("sample_no").collect()
    assert [r.frame_no for r in got] == list(range(0, last + 1, step)) and len(got) == count
    assert [r.path for r in got] == [f"d/{i:05d}.jpg" for i in range(0, last + 1, step)]


@pytest.mark.parametrize(
    "total, fps, discard, status, keep",
    [
        (100, 25, 0, "unchanged", 100), (100, 25, 1, "trimmed", 75), (100, 25, 4, "failed", None),
        (90, 29.97, 1, "trimmed", 60), (1000, 29.97, 3, "trimmed", 910), (10, 30, 0.1, "trimmed", 6),
        (10, 0, 1, "failed", None),
    ],
)
def test_trim(spark, total, fps, discard, status, keep):
    plan = sampling.trim_plan(meta(spark, (fps, total)), discard)
    row = plan.first()
    assert (row.status, row.frames_to_keep) == (status, keep)
    frames = spark.range(total).select(F.lit("c0").alias("clip_id"), F.col("id").alias("frame_no"))
    assert sampling.apply_trim(frames, plan).count() == (total if keep is None else keep)


def test_trim_summary(spark):
    plan = sampling.trim_plan(meta(spark, (25, 100), (25, 10), (25, 60)), 1)
    assert tuple(sampling.trim_summary(plan).first()) == (2, 1, 3)


def test_stride(spark):
    frames = spark.range(10).select(F.lit("a").alias("clip_id"), F.col("id").alias("sample_no"), F.col("id").alias("x"))
    got = sampling.stride(frames, 4).orderBy("sample_no").collect()
    assert [(r.sample_no, r.x) for r in got] == [(0, 0), (1, 4), (2, 8)]
    with pytest.raises(ValueError):
        sampling.stride(frames, 0)


@pytest.mark.parametrize("fps", [3, 10, 24, 30, 29.97, 7, 0.3, 0.7, 13, 1000])
def test_sums_in_closed_form(fps):
    """Bit by bit the loop, also far beyond where a product would differ."""
    from reelmeter.operators.sampling import sum_intervals

    step = 1.0 / fps
    loop = np.concatenate([[0.0], np.cumsum(np.full(1_000_000, step))])
    k = np.arange(len(loop))
    found = np.zeros(len(loop))
    for first, start, grown in sum_intervals(step):
        found[k >= first] = start + (k[k >= first] - first) * grown
    assert (found == loop).all() and len(sum_intervals(step)) < 200


@pytest.mark.parametrize("step", [0.1, 3 * 2.0**-53, 5 * 2.0**-54 + 2.0**-3])
def test_sums_with_ties(step):
    """Steps whose additions round exactly between two doubles."""
    from reelmeter.operators.sampling import sum_intervals

    t, want = 0.0, []
    for _ in range(20_000):
        want.append(t)
        t += step
    intervals = sum_intervals(step)
    found = [next(s + (k - f) * g for f, s, g in reversed(intervals) if f <= k) for k in range(20_000)]
    assert found == want


@pytest.mark.parametrize("fps", [3, 10, 24, 30])
def test_frames_in_place_at_inexact_rates(spark, fps):
    meta = spark.createDataFrame([("a", 25.0, 200), ("b", 2.0, 31), ("c", 0.5, 4), ("d", 0.0, 9)], "clip_id string, fps double, total_frames int")
    frames = meta.select("clip_id", F.explode(F.sequence(F.lit(0), F.col("total_frames") - 1)).alias("frame_no"))
    got = sampling.sample_frames(frames, meta, desired_fps=fps).select("clip_id", "sample_no", "frame_no", "t_s")
    want = sampling.fetch_frames(sampling.sample_uniform(meta, fps), frames).select("clip_id", "sample_no", "frame_no", "t_s")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 90
