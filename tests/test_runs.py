import datetime as dt
import os
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelmeter.operators import runlog, sampling, scoring
from reelmeter.plans import registry, runs
from reelmeter.sources import results

SCORE = "struct<score:double>"


def items(spark, n):
    return spark.range(n).select(F.col("id").alias("clip_id"), (F.col("id") * 2).alias("x"))


@pytest.mark.parametrize("batch_size", [1, 3, 1000])
def test_scores_do_not_depend_on_batches(spark, batch_size):
    scored = scoring.score_batches(
        items(spark, 50), lambda: 10.0, lambda m, b: [{"score": m + x} for x in b["x"]], SCORE, ["clip_id"], batch_size
    )
    got = {r.clip_id: r.score for r in scoring.scored_rows(scored).collect()}
    assert got == {i: 10.0 + 2 * i for i in range(50)}
    assert scoring.error_rows(scored).count() == 0


def test_failing_batch_marks_all_its_items(spark):
    def infer(model, batch):
        if 14 in batch["x"].values:
            raise ValueError("bad frame")
        return [{"score": 1.0}] * len(batch)

    scored = scoring.score_batches(items(spark, 20).coalesce(1), lambda: None, infer, SCORE, ["clip_id"], 4)
    failed = scoring.error_rows(scored).orderBy("clip_id").collect()
    assert [r.clip_id for r in failed] == [4, 5, 6, 7]
    assert {r.error for r in failed} == {"ValueError: bad frame"}
    assert scoring.scored_rows(scored).count() == 16
    log = scoring.run_log(scored, "m").where("error is null").first()
    assert log.finished >= log.started


def test_wrong_number_of_outputs_is_an_error(spark):
    scored = scoring.score_batches(items(spark, 3).coalesce(1), lambda: None, lambda m, b: [{"score": 1.0}], SCORE, ["clip_id"])
    assert [r.error for r in scored.collect()] == ["ValueError: 1 outputs for 3 items"] * 3


@pytest.mark.parametrize("size", [1, 4, 7, 100])
def test_batches_are_full_whatever_arrow_delivers(size):
    rng = np.random.default_rng(size)
    delivered, left = [], 50
    while left:
        n = min(left, int(rng.integers(1, 12)))
        delivered.append(pd.DataFrame({"x": range(50 - left, 50 - left + n)}))
        left -= n
    got = [list(b["x"]) for b in scoring._rebatched(iter(delivered), size)]
    assert [x for b in got for x in b] == list(range(50))
    assert all(len(b) == size for b in got[:-1]) and len(got[-1]) <= size


def test_failing_load_fails_the_job(spark):
    def load():
        raise RuntimeError("no weights")

    with pytest.raises(Exception, match="no weights"):
        scoring.score_batches(items(spark, 3), load, lambda m, b: [], SCORE, ["clip_id"]).collect()


def test_one_load_per_worker_process(spark):
    def load():
        return uuid.uuid4().hex

    scored = scoring.score_batches(
        items(spark, 64).repartition(32), load, lambda m, b: [f"{os.getpid()} {m}"] * len(b), "string", ["clip_id"]
    )
    seen = {tuple(r.result.split()) for r in scored.collect()}
    assert len(seen) == len({pid for pid, _ in seen}) <= 8


def test_spreading_items_changes_nothing(spark):
    infer = lambda m, b: [{"score": float(x)} for x in b["x"]]
    for partitions in (None, 1, 5):
        got = scoring.score_batches(items(spark, 30), lambda: 0, infer, SCORE, ["clip_id"], 4, partitions)
        assert sorted((r.clip_id, r.result.score) for r in got.collect()) == [(i, 2.0 * i) for i in range(30)]


def test_registry():
    assert set(registry.metric_names()) >= {
        "aesthetics", "motion", "shots", "subjects", "vision_reward", "nsfw", "watermark",
    }
    with pytest.raises(NotImplementedError):
        registry.get_metric("unknown")


@pytest.fixture(scope="module")
def world(spark):
    """Three clips of gray frames at 2 frames a second; clip c has no frame."""
    clips = spark.createDataFrame([("a", "/v/a"), ("b", "/v/b"), ("c", "/v/c")], "video_id string, path string")
    meta = spark.createDataFrame(
        [("a", 2.0, 8, 4, 4), ("b", 2.0, 5, 4, 4), ("c", 2.0, 0, 4, 4)],
        "clip_id string, fps double, total_frames int, width int, height int",
    )
    rows = [
        (c, f, 4, 4, "RGB", bytearray(np.full(48, 20 * f + (c == "b"), np.uint8).tobytes()))
        for c, n in (("a", 8), ("b", 5)) for f in range(n)
    ]
    table = spark.createDataFrame(rows, "clip_id string, frame_no int, height int, width int, channels string, pixels binary")
    fetch = lambda samples: sampling.fetch_frames(samples, table)
    return clips, (lambda left: runs.sampled_frames(left, meta, fetch))


def brightness(model, batch: pd.DataFrame):
    return [{"score": float(np.frombuffer(p, np.uint8).mean())} for p in batch["pixels"]]


MODEL = runs.Model(lambda: None, brightness, 2)


def by_id(df, column):
    return {r.video_id: r[column] for r in df.collect()}


def test_run_resumes_and_retries(spark, world, tmp_path):
    clips, frames = world
    root = str(tmp_path)

    def flaky(model, batch):
        if (batch["clip_id"] == "b").any():
            raise ValueError("decoder")
        return brightness(model, batch)

    first = runs.run_metric(spark, "aesthetics", clips, root, "1", runs.Model(lambda: None, flaky, 1), frames)
    got = by_id(first, "frame_aesthetic_scores")
    assert got == {"a": {0: 0.0, 1: 40.0, 2: 80.0, 3: 120.0}, "c": {}}
    log = spark.read.parquet(f"{root}/log/metric=aesthetics")
    assert {r.video_id: r.error for r in log.collect()} == {"a": None, "b": "ValueError: decoder"}
    order = ("finished", "video_id")
    assert runlog.run_summary(log).first().processed == 1
    assert runlog.checkpoint_windows(log, 1, order).agg(F.sum("items")).first()[0] == 2
    assert [r.message for r in runlog.error_summary(log, order=order).collect()] == ["ValueError: decoder"]
    failed = results.read_scored(spark, f"{root}/scored", "aesthetics", ok=False)
    assert {r.clip_id for r in failed.collect()} == {"b"}

    second = runs.run_metric(spark, "aesthetics", clips, root, "2", MODEL, frames)
    assert by_id(second, "frame_aesthetic_scores") == {"b": {0: 1.0, 1: 41.0, 2: 81.0}}
    again = runs.run_metric(spark, "aesthetics", clips, root, "2", MODEL, frames)  # replayed after a crash
    assert by_id(again, "avg_aesthetic_score") == {"b": 41.0}
    assert runs.run_metric(spark, "aesthetics", clips, root, "3", MODEL, frames).count() == 0

    whole = runs.run_metric(spark, "aesthetics", clips, f"{root}/whole", "1", MODEL, frames)
    stored = results.read_results(spark, f"{root}/results", "aesthetics")
    columns = ["video_id", "part_no", "frame_aesthetic_scores"]
    assert sorted(map(str, whole.select(columns).collect())) == sorted(map(str, stored.select(columns).collect()))


def test_damaged_results_are_scored_afresh(spark, world, tmp_path):
    clips, frames = world
    root = str(tmp_path)
    runs.run_metric(spark, "aesthetics", clips.where("video_id = 'a'"), root, "1", MODEL, frames)
    runs.run_metric(spark, "aesthetics", clips.where("video_id = 'b'"), root, "2", MODEL, frames)
    for file in (tmp_path / "results/metric=aesthetics/run_id=run-2").glob("*.parquet"):
        file.write_bytes(b"not a table" * 50)
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    got = runs.run_metric(spark, "aesthetics", clips, root, "3", MODEL, frames)
    assert set(by_id(got, "avg_aesthetic_score")) == {"b", "c"}


def test_run_slices_and_trials(spark, world, tmp_path):
    clips, frames = world
    got = runs.run_metric(spark, "aesthetics", clips, str(tmp_path / "s"), "1", MODEL, frames, start=1, end=2)
    assert list(by_id(got, "avg_aesthetic_score")) == ["b"]
    got = runs.run_metric(spark, "aesthetics", clips, str(tmp_path / "t"), "1", MODEL, frames, trial_every=50)
    assert got.count() == 3
    many = spark.range(200).select(F.format_string("%03d", F.col("id")).alias("video_id"), F.lit("p").alias("path"))
    none = lambda left: frames(left.where("false"))
    got = runs.run_metric(spark, "aesthetics", many, str(tmp_path / "u"), "1", MODEL, none, trial_every=10)
    ids = sorted(r.video_id for r in got.collect())
    assert len(ids) == 60 and ids != [f"{i:03d}" for i in range(60)]
    got = runs.run_metric(spark, "aesthetics", many, str(tmp_path / "v"), "1", MODEL, none, start=20, trial_every=10)
    assert sorted(r.video_id for r in got.collect()) == [f"{i:03d}" for i in range(20, 80)]


def test_every_metric_runs(spark, world, tmp_path):
    clips, frames = world
    person = {"x1": 0.0, "y1": 0.0, "x2": 1.0, "y2": 1.0, "label": "Person", "conf": 0.9}
    models = {
        "aesthetics": MODEL,
        "watermark": MODEL,
        "nsfw": runs.Model(lambda: None, lambda m, b: [{"label": "nsfw" if n == 0 else "normal"} for n in b["sample_no"]]),
        "subjects": runs.Model(lambda: None, lambda m, b: [[person, {**person, "conf": 0.2}] if n == 1 else [] for n in b["sample_no"]]),
        "shots": runs.Model(lambda: None, lambda m, b: [{p: f"{n}<pad>"} for p, n in zip(b["prompt"], b["sample_no"])]),
        "vision_reward": runs.Model(lambda: None, lambda m, b: ["yes"] * len(b), 100),
    }
    names = registry.metric_names()
    got = runs.run_all(spark, names, clips, str(tmp_path), "1", models, frames=frames)
    assert set(got) == set(names)
    assert by_id(got["vision_reward"], "avg_vision_reward")["c"] == pytest.approx(0.15109870265788475)
    assert by_id(got["nsfw"], "avg_nsfw_score")["a"] == 0.25
    assert by_id(got["nsfw"], "frame_nsfw_results")["b"] == {"frame_0": "nsfw", "frame_1": "normal", "frame_2": "normal"}
    assert by_id(got["subjects"], "avg_humans") == {"a": 0.25, "b": pytest.approx(1 / 3), "c": 0.0}
    shots = by_id(got["shots"], "frame_shot_categorization")
    assert shots["b"][2] == [{"<COLOR>": "2"}, {"<LIGHTING>": "2"}, {"<LIGHTING_TYPE>": "2"}, {"<COMPOSITION>": "2"}]
    assert by_id(got["motion"], "motion_flow")["a"] == 0.0


def test_strided_metric(spark, world, tmp_path):
    clips, frames = world
    metric = registry.every_nth(registry.get_metric("aesthetics"), 2)
    got = runs.run_metric(spark, metric, clips, str(tmp_path), "1", MODEL, frames)
    assert by_id(got, "frame_aesthetic_scores")["a"] == {0: 0.0, 1: 80.0}


def test_scene_clips(spark, tmp_path):
    for name in ("A_1/s1.mp4", "A_1/s2.mp4", "B/s1.mp4", "C/s1.mp4"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"x")
    catalog = spark.createDataFrame([(0, "B", "l"), (1, "A.1", "l"), (2, "B", "m"), (3, "C", "l")], "ord bigint, yt_clip_title string, yt_clip_link string")
    got = runs.scene_clips(spark, catalog, str(tmp_path), 0, 2)
    assert sorted(r.video_id for r in got.collect()) == ["s1_A_1", "s1_B", "s2_A_1"]


T0 = dt.datetime(2024, 1, 1)


def log_table(spark, outcomes):
    """One item a second; ``x`` marks a failure."""
    rows = [
        ("m", f"v{i}", i, T0 + dt.timedelta(seconds=i), T0 + dt.timedelta(seconds=i + 1), "e" * 300 if o == "x" else None)
        for i, o in enumerate(outcomes)
    ]
    return spark.createDataFrame(rows, "metric string, video_id string, seq bigint, started timestamp, finished timestamp, error string")


@pytest.mark.parametrize("max_group_rows", [0, 1000])
def test_checkpoint_windows(spark, max_group_rows):
    log = log_table(spark, "..x.." "x..." ".")
    got = runlog.checkpoint_windows(log, every=3, max_group_rows=max_group_rows).orderBy("window_no").collect()
    # three successes close a window; the failure after the fourth success counts in the second
    assert [(r.items, r.successes, r.seconds) for r in got] == [(4, 3, 4.0), (4, 3, 4.0), (2, 2, 2.0)]
    assert [r.items_per_s for r in got] == [1.0, 1.0, 1.0]


def test_summaries(spark):
    log = log_table(spark, "x.x.xxxx....")
    s = runlog.run_summary(log, workers=2).first()
    assert (s.processed, s.total_s, s.speedup, s.efficiency_pct) == (6, 12.0, 0.5, 25.0)
    errors = runlog.error_summary(log).orderBy("seq").collect()
    assert [r.seq for r in errors] == [0, 2, 4, 5, 6] and {r.n_errors for r in errors} == {6}
    assert all(len(r.message) == 100 for r in errors)
    timing = runlog.metric_timing(log).first()
    assert (timing.seconds, timing.mean_seconds) == (12.0, 12.0)
