"""The index of seen ids, and streams with state over several micro-batches."""

import os

import pytest
from pyspark.sql import functions as F

from reelmeter.streaming import runs as streams
from reelmeter.streaming.seen import SLICE, SeenIds


def ids(frame):
    return sorted(r[0] for r in frame.collect())


@pytest.fixture()
def index(tmp_path):
    return SeenIds(str(tmp_path / "seen"), buckets=8, bits=SLICE, hashes=3, merge_every=3)


def rows(spark, *values, kind="long"):
    return spark.createDataFrame([(v,) for v in values], f"k {kind}")


def test_unseen_is_exact_over_batches(spark, index):
    """Overlapping batches, with merges in between; each id is new exactly once."""
    known = set()
    for n in range(8):
        batch = set(range(n * 70, n * 70 + 100))
        got = ids(index.unseen(rows(spark, *batch), "k", n))
        assert got == sorted(batch - known)
        index.add(rows(spark, *got), "k", n)
        known |= batch
    assert os.path.isdir(f"{index.root}/merged/stop=3") and not os.path.isdir(f"{index.root}/ids/batch_id=0")


def test_new_ids_open_no_bucket(spark, index, monkeypatch):
    for n in range(3):
        index.add(rows(spark, *range(n * 100, n * 100 + 100)), "k", n)
    opened = []
    monkeypatch.setattr(SeenIds, "_folders", lambda self, spark, n: opened.append(n) or [])
    fresh = rows(spark, *range(10**6, 10**6 + 200))
    perhaps = index.perhaps(fresh, "k", 3).where("_perhaps").count()
    assert perhaps < 20
    few = index.perhaps(fresh, "k", 3).where("NOT _perhaps").select("k")
    assert index.unseen(few, "k", 3).count() == 200 - perhaps and not opened
    assert index.perhaps(rows(spark, *range(300)), "k", 3).where("NOT _perhaps").count() == 0  # nothing known is missed


def test_only_touched_buckets_are_opened(spark, index):
    index.add(rows(spark, *range(1000)), "k", 0)
    found = index.unseen(rows(spark, 5, 6, 10**9), "k", 1)
    buckets = {p for f in found.inputFiles() for p in f.split("/") if p.startswith("bucket=")}
    assert ids(found) == [10**9] and len(buckets) <= 3


def test_filters_do_not_grow(spark, index):
    sizes = []
    for n in range(4):
        index.add(rows(spark, *range(n * 1000, n * 1000 + 1000)), "k", n)
        stored = spark.read.parquet(index._filters(n)).select(F.explode("slices").alias("slice", "bits"))
        sizes.append(stored.agg(F.sum(F.octet_length("bits"))).first()[0])
    assert set(sizes) == {8 * SLICE // 8}
    assert not os.path.isdir(index._filters(1)) and os.path.isdir(index._filters(2))


def test_replayed_batch(spark, index):
    """A batch that runs again sees what was there before it, also at a merge."""
    for n in range(6):
        batch = rows(spark, *range(n * 10, n * 10 + 15))
        for _ in range(2):
            fresh = ids(index.unseen(batch, "k", n))
            assert fresh == list(range(n * 10 + (5 if n else 0), n * 10 + 15))
            index.add(rows(spark, *fresh), "k", n)


def test_odd_ids(spark, index):
    batch = rows(spark, "a", None, "", "a", "x" * 10_000, kind="string")
    assert index.unseen(batch, "k", 0).count() == 5
    index.add(batch, "k", 0)
    again = index.unseen(batch, "k", 1)
    assert [r[0] for r in again.collect()] == [None]
    index.add(again, "k", 1)
    index.add(again.where("false"), "k", 2)
    assert index.unseen(rows(spark, "a", "b", kind="string"), "k", 3).collect() == [("b",)]
    with pytest.raises(ValueError):
        SeenIds("r", bits=1000)
    with pytest.raises(ValueError):
        SeenIds("r", buckets=1 << 20)


@pytest.fixture()
def feed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def deliver(name, *values):
        spark.createDataFrame(list(values), "clip_id long, score double, ts timestamp").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "one"))
        for f in (tmp_path / "one").glob("part-*"):
            (folder / f"{name}.parquet").write_bytes(f.read_bytes())

    schema = "clip_id long, score double, ts timestamp"
    from pyspark.sql import types as T

    return deliver, lambda: streams.file_stream(spark, str(folder), T._parse_datatype_string(schema), 1), (str(tmp_path / "sink"), str(tmp_path / "checkpoint"))


def at(day):
    import datetime as dt

    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=day)


def means(spark, sink):
    return {r.clip_id: (r.n, r.mean_score) for r in streams.current_means(spark, sink).collect()}


def test_mean_state_stores_what_changed(spark, feed):
    deliver, stream, (sink, checkpoint) = feed
    want, every = {}, {}
    for n in range(4):
        scores = [(k, float(10 * n + k), at(0)) for k in range(n, n + 3)] + [(99, None, at(0)), (None, 1.0, at(0))]
        deliver(f"f{n}", *scores)
        streams.stream_mean_state(stream(), sink, checkpoint)
        for k, v, _ in scores:
            every.setdefault(k, []).extend([] if v is None else [v])
        want = {k: (len(v), sum(v) / len(v) if v else None) for k, v in every.items()}
        assert means(spark, sink) == want
    stored = spark.read.parquet(sink)
    assert stored.count() == 4 * 5 and stored.select("batch_id").distinct().count() == 4  # five clips a batch, not all


def test_windows_leave_the_state(spark, feed):
    """With a watermark, windows are dropped from the state; their stored sums still count."""
    deliver, stream, (sink, checkpoint) = feed
    for n, day in enumerate((0, 1, 5, 9, 13)):
        deliver(f"f{n}", (1, float(n), at(day)), (2, 1.0, at(day)))
        streams.stream_mean_state(stream(), sink, checkpoint, time="ts", width="1 day", delay="1 day")
    deliver("late", (1, 1000.0, at(0)))  # too late: its window has left
    streams.stream_mean_state(stream(), sink, checkpoint, time="ts", width="1 day", delay="1 day")
    assert means(spark, sink) == {1: (5, 2.0), 2: (5, 1.0)}


def test_indexed_scoring(spark, feed):
    deliver, stream, (sink, checkpoint) = feed
    asked = spark.sparkContext.accumulator(0)
    index = SeenIds(f"{sink}-seen", buckets=4, bits=SLICE, merge_every=2)

    def score(batch):
        def count(batches):
            for pdf in batches:
                asked.add(len(pdf))
                yield pdf[["video_id", "score"]]

        return batch.mapInPandas(count, "video_id long, score double")

    for n in range(5):
        deliver(f"f{n}", *[(k % 20, 1.0, at(0)) for k in range(3 * n, 3 * n + 8)] * 2)
        named = stream().select(F.col("clip_id").alias("video_id"), "score")
        streams.score_stream_indexed(named, score, sink, checkpoint, index)
    stored = spark.read.parquet(sink)
    assert sorted(r.video_id for r in stored.collect()) == list(range(20)) and asked.value == 20
