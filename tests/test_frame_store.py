"""Frames read by position: what is read, and that nothing else is."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, IsNotNull, LessThan

from reelmeter.operators import cropping, sampling
from reelmeter.sources import frame_store as fs

CLIPS, FRAMES, H, W = 6, 40, 12, 10


def pixels(k, f):
    return ((np.arange(H * W) * 7 + 13 * f + 31 * k) % 256).astype(np.uint8).tobytes()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "frames")
    rows = [(f"clip{k}", f, H, W, "GRAY", pixels(k, f)) for k in range(CLIPS) for f in range(FRAMES)]
    frames = spark.createDataFrame(rows, "clip_id string, frame_no int, height int, width int, channels string, pixels binary")
    fs.write_frame_store(frames.repartition(5), path, file_bytes=3000)
    return path


class Counted:
    """A file system that counts what is read of pixel files."""

    def __init__(self, inner, log):
        self.inner, self.log = inner, log

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def open_input_file(self, path):
        return CountedFile(self.inner.open_input_file(path), self.log)


class CountedFile:
    def __init__(self, inner, log):
        self.inner, self.log = inner, log

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.inner.close()

    def read_at(self, size, offset):
        self.log.append(size)
        return self.inner.read_at(size, offset)


@pytest.fixture()
def read_bytes(monkeypatch):
    log, plain = [], fs._filesystem

    def counted(path):
        system, root = plain(path)
        return (Counted(system, log), root) if path.endswith("pixels") else (system, root)

    monkeypatch.setattr(fs, "_filesystem", counted)
    monkeypatch.setattr(fs, "GAP", 0)
    return log


def test_index(spark, store):
    index = fs.frame_index(spark, store)
    assert index.count() == CLIPS * FRAMES and "pixels" not in index.columns
    assert index.agg(F.sum("length")).first()[0] == CLIPS * FRAMES * H * W
    assert index.select("file").distinct().count() >= 5  # files are closed at their size


def test_every_frame_comes_back(spark, store):
    found = fs.read_pixels(fs.frame_index(spark, store), store).collect()
    assert len(found) == CLIPS * FRAMES
    assert all(bytes(r.pixels) == pixels(int(r.clip_id[4:]), r.frame_no) for r in found)


def exchanged(frame):
    """Columns that an exchange of the plan takes in."""
    plan = frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [x for block in re.split(r"\n\n", plan) if re.match(r"\(\d+\) (Broadcast)?Exchange", block) for x in re.findall(r"(\w+)#", block)]


def test_pixels_are_in_no_exchange(spark, store, monkeypatch):
    from reelmeter.operators import ordering

    meta = fs.frame_index(spark, store).groupBy("clip_id").agg(
        F.count("*").cast("int").alias("total_frames"), F.first("height").alias("height"), F.lit(4.0).alias("fps")
    )
    for rows in (0, 10**6):  # with and without a broadcast of what is known per clip
        monkeypatch.setattr(ordering.attach, "__defaults__", ("inner", True, rows))
        index = fs.frame_index(spark, store)
        chosen = fs.read_pixels(sampling.sample_frames(index, meta), store)
        trimmed = fs.read_pixels(sampling.apply_trim(index, sampling.trim_plan(meta, 5)), store)
        plan = cropping.clip_crop_plan(meta, index, fetch=lambda r: fs.read_pixels(r, store))
        cropped = fs.read_pixels(fs.crop_places(index, plan, depth=1), store)
        for frame in (chosen, trimmed, cropped):
            names = exchanged(frame)
            assert names and not {"pixels", "gray"} & set(names)
        got = {(r.clip_id, r.frame_no): bytes(r.pixels) for r in chosen.collect()}
        assert got == {(f"clip{k}", f): pixels(k, f) for k in range(CLIPS) for f in range(0, FRAMES, 4)}
        assert trimmed.count() == CLIPS * 20


def test_bytes_follow_the_choice(spark, store, read_bytes):
    index = fs.frame_index(spark, store).toArrow()
    for step in (1, 4, 20):
        read_bytes.clear()
        chosen = index.filter(pa.array([f % step == 0 for f in index["frame_no"].to_pylist()]))
        found = [b for b in fs._cells(chosen, fs._pixels(store))]
        assert sum(b.num_rows for b in found) == chosen.num_rows
        assert sum(read_bytes) == chosen.num_rows * H * W  # not a byte of the others


def test_cropped_rows_are_not_read(spark, store, read_bytes):
    plan = spark.createDataFrame([("clip1", "cropped", 3, 7), ("clip2", "skipped", 0, H)], "clip_id string, status string, start_y int, end_y int")
    index = fs.frame_index(spark, store).where("clip_id IN ('clip1', 'clip2')")
    narrowed = fs.crop_places(index, plan, depth=1)
    for batch in fs._cells(narrowed.toArrow(), fs._pixels(store)):
        for r in batch.to_pylist():
            whole = pixels(int(r["clip_id"][4:]), r["frame_no"])
            assert r["pixels"] == (whole[3 * W : 7 * W] if r["clip_id"] == "clip1" else whole)
            assert r["height"] == (4 if r["clip_id"] == "clip1" else H)
    assert sum(read_bytes) == FRAMES * W * (4 + H)


def test_neighbours_are_read_together():
    offsets, ends = np.array([0, 100, 150, 5000, 9000]), np.array([100, 200, 160, 5100, 9100])
    assert list(fs._joined_reads(offsets, ends, gap=10)) == [(0, 3), (3, 4), (4, 5)]
    assert list(fs._joined_reads(offsets, ends, gap=4800)) == [(0, 5)]
    assert list(fs._joined_reads(offsets[:0], ends[:0], 0)) == []


def test_filters_are_pushed(spark, store, read_bytes):
    def reader():
        return fs.FrameStore({"path": store}).reader(fs.FrameStore({"path": store}).schema())

    r = reader()
    left = list(r.pushFilters([EqualTo(("clip_id",), "clip3"), In(("frame_no",), (5, 9)), IsNotNull(("clip_id",)), LessThan(("pixels",), b"")]))
    assert [type(f) for f in left] == [IsNotNull, LessThan]  # these stay with Spark
    rows = [x for p in r.partitions() for b in r.read(p) for x in b.to_pylist()]
    assert sorted((x["clip_id"], x["frame_no"]) for x in rows) == [("clip3", 5), ("clip3", 9)]
    assert sum(read_bytes) == 2 * H * W
    r = reader()
    assert not list(r.pushFilters([GreaterThanOrEqual(("frame_no",), FRAMES)]))
    read_bytes.clear()
    assert not [x for p in r.partitions() for b in r.read(p) for x in b.to_pylist()] and not read_bytes


def test_data_source(spark, store):
    load = lambda **o: fs.read_frame_store(spark, store, **o)
    some = load().where("clip_id = 'clip2' AND frame_no BETWEEN 10 AND 12")
    assert {(r.frame_no, bytes(r.pixels)) for r in some.collect()} == {(f, pixels(2, f)) for f in (10, 11, 12)}
    assert load().where("frame_no % 2 = 1").count() == CLIPS * FRAMES // 2  # not a filter that can be pushed
    assert load().where("frame_no < 7").union(load().where("frame_no >= 7")).count() == CLIPS * FRAMES
    assert "pixels" not in load(pixels=False).columns and load(pixels=False).count() == CLIPS * FRAMES


def test_odd_frames(spark, tmp_path):
    """Null and empty pixels, repeated frames, null ids, further columns with the names of places, no frames."""
    path = str(tmp_path / "odd")
    rows = [("a", 0, b"xy", 1), ("a", 0, b"xy", 1), (None, 1, b"", 2), ("b", None, None, 3), ("c", 5, b"z" * 100_000, None)]
    frames = spark.createDataFrame(rows, "clip_id string, frame_no int, pixels binary, extra int")
    fs.write_frame_store(frames, path)
    found = sorted(str(tuple(r)) for r in fs.read_pixels(fs.frame_index(spark, path), path).select("clip_id", "frame_no", "pixels", "extra").collect())
    assert found == sorted(str(tuple(r)) for r in frames.collect())
    assert fs.read_frame_store(spark, path).count() == 5
    empty = str(tmp_path / "empty")
    fs.write_frame_store(frames.where("false"), empty)
    assert fs.read_pixels(fs.frame_index(spark, empty), empty).count() == 0
    assert fs.read_frame_store(spark, empty).count() == 0
    with pytest.raises(ValueError, match="taken"):
        fs.write_frame_store(frames.withColumnRenamed("extra", "offset"), str(tmp_path / "clash"))
