"""Chunked runs: stopped, taken up, interrupted."""

import os

import pytest
from pyspark.sql import functions as F

from reelmeter.operators.metrics import aesthetics
from reelmeter.operators.scoring import scored_rows
from reelmeter.plans import chunks
from reelmeter.plans.registry import Metric
from reelmeter.plans.runs import Model
from reelmeter.sources import results

METRIC = Metric(
    "chunked", "frames", ("clip_id", "sample_no"), "struct<score:double>", lambda frames: frames,
    lambda clips, items, scored: aesthetics(clips, scored_rows(scored)),
)


@pytest.fixture()
def job(spark, tmp_path):
    clips = spark.range(50).select(F.format_string("c%02d", "id").alias("video_id"))
    asked = spark.sparkContext.accumulator(0)

    def frames(left):
        return left.select(F.col("video_id").alias("clip_id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("sample_no"))

    def go(root="run", run_id="1", bad=(), clips=clips, **options):
        def infer(_, batch):
            asked.add(len(batch))
            if set(batch["clip_id"]) & set(bad):
                raise ValueError("bad clip")
            return [{"score": float(int(c[1:]) + n)} for c, n in zip(batch["clip_id"], batch["sample_no"])]

        return chunks.run_chunked(spark, METRIC, clips, str(tmp_path / root), run_id, Model(lambda: None, infer, 1), frames, chunk_clips=12, **options)

    return spark, tmp_path, clips, asked, go


def scores(frame):
    return {r.video_id: r.avg_aesthetic_score for r in frame.collect()}


def test_stopped_and_taken_up(job):
    spark, tmp_path, clips, asked, go = job
    root = str(tmp_path / "run")
    first = go(max_chunks=2)
    assert [r.chunk_no for r in first.orderBy("chunk_no").collect()] == [0, 1] and asked.value == 24 * 3
    assert chunks.committed_results(spark, root, "chunked", "1").count() == 24
    done = go()
    assert done.count() == 5 and asked.value == 50 * 3  # no id is scored twice
    got = chunks.committed_results(spark, root, "chunked", "1")
    assert scores(got) == {f"c{i:02d}": i + 1.0 for i in range(50)} and got.count() == 50
    assert {(r.chunk_no, r.clips, r.results, r.failed) for r in done.collect()} == {(n, 12, 12, 0) for n in range(4)} | {(4, 2, 2, 0)}
    assert go().count() == 5 and asked.value == 50 * 3  # a whole run is not run again
    go(root="whole")
    assert scores(chunks.committed_results(spark, str(tmp_path / "whole"), "chunked", "1")) == scores(got)
    progress = chunks.chunk_progress(done).orderBy("chunk_no").collect()
    assert all(r.seconds > 0 and r.items_per_s == pytest.approx(r.results / r.seconds) for r in progress)


def test_lost_commit_writes_the_chunk_anew(job):
    """A driver that is lost between results and commit leaves a chunk that the next call replaces."""
    spark, tmp_path, clips, asked, go = job
    root = tmp_path / "run"
    go(max_chunks=3)
    gone = root / "commits" / "metric=chunked" / "run_id=run-1" / "chunk-000002"
    for f in os.listdir(gone):
        os.remove(gone / f)
    os.rmdir(gone)
    assert chunks.committed_results(spark, str(root), "chunked", "1").count() == 24
    assert results.read_results(spark, f"{root}/results", "chunked").count() == 36  # results without a commit
    go()
    got = chunks.committed_results(spark, str(root), "chunked", "1")
    assert got.count() == 50 == got.select("video_id").distinct().count()
    assert results.read_results(spark, f"{root}/results", "chunked").count() == 50
    assert asked.value == (50 + 12) * 3  # only that chunk was scored again


def test_lost_plan_is_made_anew(job):
    spark, tmp_path, clips, asked, go = job
    plan = tmp_path / "run" / "plan" / "metric=chunked" / "run_id=run-1"
    plan.mkdir(parents=True)
    (plan / "part-torn.parquet").write_bytes(b"half a file")
    assert go().count() == 5


def test_failed_clips_wait_for_another_run(job):
    spark, tmp_path, clips, asked, go = job
    root = str(tmp_path / "run")
    done = go(bad=("c03", "c40"))
    assert {r.chunk_no: r.failed for r in done.collect()} == {0: 1, 1: 0, 2: 0, 3: 1, 4: 0}
    asked.add(-asked.value)
    again = go(run_id="2")
    assert [(r.clips, r.results) for r in again.collect()] == [(2, 2)] and asked.value == 6
    assert scores(results.read_results(spark, f"{root}/results", "chunked")) == {f"c{i:02d}": i + 1.0 for i in range(50)}


def test_odd_lists(job):
    spark, tmp_path, clips, asked, go = job
    assert go(clips=clips.where("false")).count() == 0
    assert chunks.committed_results(spark, str(tmp_path / "run"), "chunked", "1") is None
    twice = clips.union(clips).withColumn("chunk_no", F.lit(7)).drop("chunk_no")
    assert go(root="twice", clips=twice).agg(F.sum("results")).first()[0] == 50
