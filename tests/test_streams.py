import os

import pytest
from pyspark.sql import functions as F

from reelmeter.plans.runs import Model, run_metric
from reelmeter.sources import files, results
from reelmeter.streaming import runs as streams

SF = "/root/testdata/sf0.001"
PARTS = 5


@pytest.fixture()
def feed(spark, tmp_path):
    """Events in order of time, a file a part; ``deliver`` adds parts to the folder."""
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    parts = events.repartitionByRange(PARTS, "ts").withColumn("part", F.spark_partition_id())
    parts.write.partitionBy("part").parquet(str(tmp_path / "parts"))
    folder = str(tmp_path / "in")
    os.makedirs(folder)

    def deliver(*numbers, name=""):
        for n in numbers:
            source = tmp_path / "parts" / f"part={n}"
            for f in source.glob("*.parquet"):
                (tmp_path / "in" / f"{name}{n}-{f.name}").write_bytes(f.read_bytes())

    def stream():
        return streams.file_stream(spark, folder, events.schema, files_per_batch=1)

    return events, deliver, stream, (str(tmp_path / "sink"), str(tmp_path / "checkpoint"))


def test_score_stream_resumes_and_skips(spark, feed):
    events, deliver, stream, (sink, checkpoint) = feed
    asked = spark.sparkContext.accumulator(0)

    def score(batch):
        def count(batches):
            for pdf in batches:
                asked.add(len(pdf))
                yield pdf.assign(score=pdf.value * 2)[["video_id", "score"]]

        return batch.select("video_id", "value").mapInPandas(count, "video_id bigint, score double")

    def go():
        streams.score_stream(stream().withColumn("video_id", F.col("event_id")), score, sink, checkpoint)
        return spark.read.parquet(sink)

    deliver(0, 1)
    first = go().count()
    deliver(2, 3, 4)
    deliver(1, name="again-")  # ids seen before are not scored again
    got = go()
    want = events.select(F.col("event_id").alias("video_id"), (F.col("value") * 2).alias("score"))
    assert 0 < first < 1000 and got.count() == 1000
    assert got.select("video_id", "score").exceptAll(want).count() == 0
    assert go().count() == 1000 and asked.value == 1000
    assert got.select("batch_id").distinct().count() == PARTS


def test_replayed_batch_keeps_its_rows(spark, feed):
    """A batch whose commit was lost runs again and must not skip its own ids."""
    events, deliver, stream, (sink, checkpoint) = feed
    score = lambda batch: batch.select("video_id", "value")
    deliver(0, 1)
    streams.score_stream(stream().withColumn("video_id", F.col("event_id")), score, sink, checkpoint)
    before = spark.read.parquet(sink).count()
    commits = os.path.join(checkpoint, "commits")
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for n in os.listdir(commits):
        if n.strip(".").split(".")[0] == str(last):
            os.remove(os.path.join(commits, n))
    streams.score_stream(stream().withColumn("video_id", F.col("event_id")), score, sink, checkpoint)
    assert spark.read.parquet(sink).count() == before


def test_repeats_in_one_batch_are_scored_once(spark, feed):
    events, deliver, stream, (sink, checkpoint) = feed
    deliver(0)
    twice = lambda: stream().withColumn("video_id", F.floor(F.col("event_id") / 2))
    streams.score_stream(twice(), lambda batch: batch.select("video_id", "value"), sink, checkpoint)
    got = spark.read.parquet(sink)
    assert got.count() == got.select("video_id").distinct().count() > 0


def test_metric_over_arriving_clips(spark, tmp_path):
    folder = tmp_path / "clips"
    folder.mkdir()
    model = Model(lambda: None, lambda m, b: [{"score": float(len(c))} for c in b["clip_id"]], 2)
    frames = lambda clips: clips.select(F.col("video_id").alias("clip_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("sample_no"))
    root, checkpoint = str(tmp_path / "root"), str(tmp_path / "checkpoint")

    def go(*names):
        for name in names:
            (folder / name).write_bytes(b"clip")
        streams.stream_metric(streams.clip_stream(spark, str(folder), 2), "aesthetics", root, checkpoint, model, frames)
        return results.read_results(spark, f"{root}/results", "aesthetics")

    go("a.mp4", "bb.mp4", "ccc.mp4", "notes.txt")
    got = go("dddd.mp4").collect()
    assert {r.video_id: r.avg_aesthetic_score - len(str(folder)) for r in got} == {
        f"{folder}/{n}.mp4": len(n) + 5.0 for n in ("a", "bb", "ccc", "dddd")
    }
    assert len(got) == 4 and len({r.run_id for r in got}) == 3
    assert go().count() == 4
    whole = run_metric(spark, "aesthetics", files.clip_manifest(spark, str(folder)), f"{root}/whole", "1", model, frames)
    columns = ["video_id", "part_no", "avg_aesthetic_score", "frame_aesthetic_scores"]
    assert sorted(map(str, whole.select(columns).collect())) == sorted(map(str, go().select(columns).collect()))


def test_running_mean_equals_batch(spark, feed):
    events, deliver, stream, (sink, checkpoint) = feed
    go = lambda: streams.stream_running_mean(
        stream().select(F.col("user_id").alias("clip_id"), F.col("value").alias("score")), sink, checkpoint
    )
    deliver(0, 1, 2)
    go()
    early = streams.running_means(spark, sink).agg(F.sum("n")).first()[0]
    deliver(3, 4)
    go()
    got = {r.clip_id: (r.n, r.mean_score) for r in streams.running_means(spark, sink).collect()}
    want = events.groupBy("user_id").agg(F.count("value"), F.avg("value")).collect()
    assert 0 < early < 1000
    assert got == {r[0]: (r[1], pytest.approx(r[2])) for r in want}


def test_throughput_of_parts_in_any_order(spark, feed):
    events, deliver, stream, (sink, checkpoint) = feed
    for part in (3, 0, 4, 1, 2):
        deliver(part)
        streams.stream_throughput(stream(), sink, checkpoint, "ts", "1 day", "40 days")
    got = {r.window_start: r["items"] for r in streams.latest_windows(spark, sink).collect()}
    want = events.groupBy(F.window("ts", "1 day").alias("w")).agg(F.count("ts").alias("n")).collect()
    assert got == {r.w.start: r.n for r in want}


def test_late_part_is_dropped_by_a_short_watermark(spark, feed):
    events, deliver, stream, (sink, checkpoint) = feed
    deliver(1, 2, 3, 4)
    streams.stream_throughput(stream(), sink, checkpoint, "ts", "1 day", "1 hour")
    deliver(0)
    streams.stream_throughput(stream(), sink, checkpoint, "ts", "1 day", "1 hour")
    kept = streams.latest_windows(spark, sink).agg(F.sum("items")).first()[0]
    assert kept < 1000


def test_dedupe(spark, feed):
    events, deliver, stream, (sink, checkpoint) = feed
    keyed = lambda: stream().select(F.col("event_id").alias("video_id"), "ts")
    deliver(0, 1)
    deliver(0, name="copy-")
    streams.stream_dedupe(keyed(), sink, checkpoint, "ts", "40 days")
    deliver(2, 3, 4)
    deliver(1, name="late-copy-")
    streams.stream_dedupe(keyed(), sink, checkpoint, "ts", "40 days")
    ids = [r.video_id for r in spark.read.parquet(sink).collect()]
    assert len(ids) == 1000 and len(set(ids)) == 1000
