"""Frames read by position: pixels in plain files, a Parquet index of where each frame lies.

Choosing, trimming and cropping are done on the index, a few numbers a frame;
pixels are read last, by offset, in the tasks that use them. What is not chosen
is not read, and pixels are in no shuffle. ``FrameStore`` is the same as a data
source with filters on clip and frame pushed into the read.

A store is a folder: ``pixels/*.bin`` (frames one after the other) and
``index`` (clip_id, frame_no, further columns of the frames, file, offset,
length; sorted by clip and frame, so filters prune files and row groups).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from reelmeter.session import discard, task_count

#: A pixel file is closed beyond this size, and tasks are dealt stretches of it of this size.
FILE_BYTES, STRETCH = 1 << 30, 16 << 20
#: Frames that are less than this apart in a file are read together.
GAP = 64 << 10
#: Bytes of pixels handed to Spark at a time.
AT_ONCE = 8 << 20
PLACE = ("file", "offset", "length")


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "", 1))


def _pixels(path: str) -> str:
    return f"{path.rstrip('/')}/pixels"


def _index(path: str) -> str:
    return f"{path.rstrip('/')}/index"


# ---- writing ----------------------------------------------------------------


def _laid_down(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    fs, root = _filesystem(folder)
    out, name, at = None, "", 0
    try:
        for batch in batches:
            cells = batch["pixels"]
            names, offsets, lengths = [], [], []
            for cell in cells:
                raw = cell.as_buffer() if cell.is_valid else None
                if out is None or at > file_bytes:
                    if out is not None:
                        out.close()
                    # a name of its own for every attempt: the index of a failed one is never committed
                    name, at = f"{uuid.uuid4().hex}.bin", 0
                    out = fs.open_output_stream(f"{root}/{name}")
                names.append(name if raw is not None else None)
                offsets.append(at if raw is not None else None)
                lengths.append(raw.size if raw is not None else None)
                if raw is not None:
                    out.write(raw)
                    at += raw.size
            places = [pa.array(names, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
            rest = [n for n in batch.schema.names if n != "pixels"]
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in rest], *places], [*rest, *PLACE])
    finally:
        if out is not None:
            out.close()


def write_frame_store(frames: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Store ``frames`` (clip_id, frame_no, pixels binary, further columns) under ``path``, a folder that executors share.

    Pixels are written where the frames are, without a shuffle. The index, without pixels, is then
    sorted by clip and frame. A null cell stays null; repeated frames are stored as often as they occur.
    """
    spark = frames.sparkSession
    if clash := [c for c in frames.columns if c in PLACE]:
        raise ValueError(f"column names that are taken: {', '.join(clash)}")
    fs, root = _filesystem(_pixels(path))
    fs.create_dir(root, recursive=True)
    rest = [f for f in frames.schema if f.name != "pixels"]
    place = [T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())]
    rows = frames.withColumn("pixels", F.col("pixels").cast("binary")).mapInArrow(
        lambda b: _laid_down(b, _pixels(path), file_bytes), T.StructType([*rest, *place])
    )
    # committed as it comes, so that what lies in pixel files is written down exactly once
    raw = f"{path.rstrip('/')}/unsorted"
    rows.write.parquet(raw)
    listed = spark.read.schema(rows.schema).parquet(raw)
    listed.repartitionByRange(task_count(spark), "clip_id", "frame_no").sortWithinPartitions("clip_id", "frame_no").write.option(
        "parquet.block.size", 1 << 20
    ).parquet(_index(path))
    discard(spark, raw)


# ---- reading ----------------------------------------------------------------


def frame_index(spark: SparkSession, path: str) -> DataFrame:
    """A row per frame without its pixels; ``file``, ``offset`` and ``length`` say where they are."""
    return spark.read.parquet(_index(path))


def _joined_reads(offsets: np.ndarray, ends: np.ndarray, gap: int) -> Iterator[tuple[int, int]]:
    """(first, stop) of runs of frames, in order of offset, that one read fetches."""
    first = 0
    reach = ends[0] if len(ends) else 0
    for i in range(1, len(offsets)):
        if offsets[i] > reach + gap or ends[i] - offsets[first] > AT_ONCE:
            yield first, i
            first, reach = i, ends[i]
        reach = max(reach, ends[i])
    if len(offsets):
        yield first, len(offsets)


def _cells(rows: pa.Table, folder: str, cells: str = "pixels") -> Iterator[pa.RecordBatch]:
    """``rows`` in order of place, with their pixels in front of file, offset and length."""
    fs, root = _filesystem(folder)
    rows = rows.sort_by([("file", "ascending"), ("offset", "ascending")])
    names = rows["file"].to_pylist()
    offsets = rows["offset"].fill_null(0).to_numpy()
    ends = offsets + rows["length"].fill_null(0).to_numpy()
    begin = 0
    while begin < len(names):
        stop = begin + 1
        while stop < len(names) and names[stop] == names[begin]:
            stop += 1
        if names[begin] is None:
            yield from _with(rows.slice(begin, stop - begin), [None] * (stop - begin), cells)
        else:
            with fs.open_input_file(f"{root}/{names[begin]}") as source:
                for a, b in _joined_reads(offsets[begin:stop], ends[begin:stop], GAP):
                    a, b = a + begin, b + begin
                    low = int(offsets[a])
                    block = source.read_at(int(ends[a:b].max()) - low, low)
                    found = [block[int(o) - low : int(e) - low] for o, e in zip(offsets[a:b], ends[a:b])]
                    yield from _with(rows.slice(a, b - a), found, cells)
        begin = stop


def _with(rows: pa.Table, found: list, cells: str) -> Iterator[pa.RecordBatch]:
    columns = {n: rows[n] for n in rows.schema.names if n not in PLACE}
    yield from pa.table({**columns, cells: pa.array(found, pa.binary())}).to_batches()


def _fetched(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _cells(pa.Table.from_batches([batch]), folder)


def read_pixels(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` of ``frame_index`` (any choice of them, with any further columns) with ``pixels`` in place of their place.

    Rows are dealt by stretches of the pixel files, so a task reads forwards and a clip that holds
    a third of all frames is shared by many; what is shuffled are places, never pixels. Rows whose
    ``offset`` and ``length`` were narrowed get that part of the frame, and only it is read.
    """
    schema = T.StructType([f for f in rows.schema if f.name not in PLACE] + [T.StructField("pixels", T.BinaryType())])
    stretch = F.floor(F.col("offset") / STRETCH)
    dealt = rows.repartition(task_count(rows.sparkSession), "file", stretch).sortWithinPartitions("file", "offset")
    folder = _pixels(path)
    return dealt.mapInArrow(lambda b: _fetched(b, folder), schema)


def crop_places(rows: DataFrame, plan: DataFrame, depth: int = 3) -> DataFrame:
    """Index rows narrowed to the pixel rows that a crop plan keeps: what is cut off is not read.

    ``plan`` is that of ``clip_crop_plan``; clips that are not to be cropped stay whole.
    """
    from reelmeter.operators.ordering import attach

    lines = plan.where("status = 'cropped'").select("clip_id", "start_y", "end_y")
    joined = attach(rows, lines, "clip_id", F.col("frame_no"), how="left")
    start = F.coalesce("start_y", F.lit(0))
    end = F.least(F.coalesce("end_y", "height"), "height")
    line = F.col("width").cast("long") * F.lit(depth)
    return joined.withColumns(
        {"offset": F.col("offset") + start * line, "length": (end - start) * line, "height": (end - start).cast("int")}
    ).drop("start_y", "end_y")


# ---- as a data source -------------------------------------------------------

_OPERATORS = {
    EqualTo: lambda f, v: f == v, GreaterThan: lambda f, v: f > v, GreaterThanOrEqual: lambda f, v: f >= v,
    LessThan: lambda f, v: f < v, LessThanOrEqual: lambda f, v: f <= v, In: lambda f, v: f.isin(list(v)),
}


@dataclass
class IndexPart(InputPartition):
    """A file of the index."""

    file: str


class FrameStoreReader(DataSourceReader):
    """Reads index files in parallel, then the pixels of the rows that passed the pushed filters."""

    def __init__(self, path: str, schema: T.StructType, pixels: bool):
        self.path, self.schema, self.pixels = path, schema, pixels
        self.conditions: list[tuple[type, str, object]] = []

    def pushFilters(self, filters):
        stored = {f.name for f in self.schema} - {"pixels"}
        for f in filters:
            if type(f) in _OPERATORS and len(f.attribute) == 1 and f.attribute[0] in stored:
                self.conditions.append((type(f), f.attribute[0], f.value))
            else:
                yield f

    def _condition(self):
        kept = None
        for kind, name, value in self.conditions:
            one = _OPERATORS[kind](ds.field(name), value)
            kept = one if kept is None else kept & one
        return kept

    def _files(self) -> list[str]:
        fs, root = _filesystem(_index(self.path))
        found = fs.get_file_info(pafs.FileSelector(root))
        return sorted(f.path for f in found if os.path.basename(f.path).startswith("part-"))

    def partitions(self):
        return [IndexPart(f) for f in self._files()] or [IndexPart("")]

    def read(self, partition: IndexPart) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, _ = _filesystem(_index(self.path))
        stored = [f.name for f in self.schema if f.name != "pixels"]
        scan = ds.dataset(partition.file, filesystem=fs, format="parquet").scanner(
            columns=stored + list(PLACE), filter=self._condition(), use_threads=False
        )
        for batch in scan.to_batches():
            rows = pa.Table.from_batches([batch])
            if not rows.num_rows:
                continue
            if self.pixels:
                yield from (b.select([f.name for f in self.schema]) for b in _cells(rows, _pixels(self.path)))
            else:
                yield from rows.select(stored).to_batches()


class FrameStore(DataSource):
    """``spark.read.format("frame_store").load(path)``; option ``pixels`` false leaves them out.

    Comparisons and ``IN`` on clip, frame and the other stored columns are pushed into the read (where
    ``spark.sql.python.filterPushdown.enabled`` is set): they prune row groups of the index by its statistics, and
    pixels are read of rows that pass only.
    """

    @classmethod
    def name(cls) -> str:
        return "frame_store"

    def _pixels_wanted(self) -> bool:
        return self.options.get("pixels", "true").lower() != "false"

    def schema(self) -> T.StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        fs, root = _filesystem(_index(self.options["path"]))
        kept = [f for f in ds.dataset(root, filesystem=fs, format="parquet").schema if f.name not in PLACE]
        fields = list(from_arrow_schema(pa.schema(kept)))
        return T.StructType(fields + ([T.StructField("pixels", T.BinaryType())] if self._pixels_wanted() else []))

    def reader(self, schema: T.StructType) -> FrameStoreReader:
        return FrameStoreReader(self.options["path"], schema, self._pixels_wanted())


def read_frame_store(spark: SparkSession, path: str, pixels: bool = True) -> DataFrame:
    """The store through the data source, with filters pushed down.

    Call this once for every place that the store has in a query: Spark keeps one set of pushed filters for
    each loaded table, so two differently filtered uses of one table would read the same rows.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FrameStore)
    return spark.read.format("frame_store").option("pixels", str(pixels).lower()).load(path)
