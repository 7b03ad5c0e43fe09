"""Token ids in compressed files: bit-plane or byte-plane shuffling with a chunk index.

A *segment* is one record of the output: a run of whole documents in ascending
order, their ids cut into chunks of ``CHUNK`` ids. The ids of a chunk are
transposed (all lowest bytes, then all next bytes, ...; or the same by bits),
every plane is compressed by itself with zstandard. A segment carries
the index of its chunks (where each plane ends) and of its documents, so any
chunk, plane or document can be read without the rest. Segments are stored as
rows of Parquet files, because Spark's writers reach every file system and
commit or drop the output of a lost task as a whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelmeter.llm.tokens import tokenizer_path, word_tokens

CHUNK = 1 << 16
#: A segment is closed once it holds so many ids; one longer document is a segment of its own.
SEGMENT = 1 << 18

SEGMENTS = (
    "shard int, segment int, n_ids long, planes string, doc_ids array<long>, doc_ends array<long>, "
    "chunk_ids array<int>, plane_ends array<long>, payload binary"
)
_READ = "shard int, segment int, doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """The planes of a chunk of ids, lowest first; bits are packed eight to a byte."""
    octets = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [np.ascontiguousarray(octets[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(parts: list[bytes], n: int, planes: str) -> np.ndarray:
    if planes == "byte":
        octets = np.stack([np.frombuffer(p, np.uint8) for p in parts], axis=1)
    else:
        bits = [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in parts]
        octets = np.packbits(np.stack(bits, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)[:n]


def encode_segment(ids: np.ndarray, planes: str, level: int = 1) -> tuple[list[int], list[int], bytes]:
    """(ids per chunk, end of every plane in the payload, payload)."""
    pack = zstandard.ZstdCompressor(level=level).compress
    sizes, ends, out, at = [], [], [], 0
    for k in range(0, len(ids), CHUNK):
        chunk = ids[k : k + CHUNK]
        sizes.append(len(chunk))
        for plane in to_planes(chunk, planes):
            out.append(pack(plane))
            at += len(out[-1])
            ends.append(at)
    return sizes, ends, b"".join(out)


def decode_segment(sizes: list[int], ends: list[int], payload: bytes, planes: str) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor().decompress
    per = 4 if planes == "byte" else 32
    starts = [0, *ends]
    chunks = [
        from_planes([unpack(payload[starts[k * per + j] : starts[k * per + j + 1]]) for j in range(per)], n, planes)
        for k, n in enumerate(sizes)
    ]
    return np.concatenate(chunks) if chunks else np.zeros(0, "<u4")


def _segments(batches: Iterator[pa.RecordBatch], path: str, planes: str) -> Iterator[pa.RecordBatch]:
    tokens, shard = word_tokens(path), TaskContext.get().partitionId()
    docs, ends, parts, held, number = [], [], [], 0, 0

    def closed() -> pa.RecordBatch:
        sizes, plane_ends, payload = encode_segment(np.concatenate(parts), planes)
        row = (shard, number, held, planes, docs, ends, sizes, plane_ends, payload)
        return pa.RecordBatch.from_pydict({n: pa.array([v], t) for (n, t), v in zip(_ARROW, row)})

    for batch in batches:
        doc_ids = batch["doc_id"].to_pylist()
        for first, ids, stops in tokens.documents(batch):
            at = 0
            for doc_id, stop in zip(doc_ids[first:], stops.tolist()):
                if docs and held + stop - at > SEGMENT:
                    yield closed()
                    docs, ends, parts, held, number = [], [], [], 0, number + 1
                parts.append(ids[at:stop])
                held += stop - at
                docs.append(doc_id)
                ends.append(held)
                at = stop
    if docs:
        yield closed()


_ARROW = [
    ("shard", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()), ("planes", pa.string()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_ends", pa.list_(pa.int64())),
    ("chunk_ids", pa.list_(pa.int32())), ("plane_ends", pa.list_(pa.int64())), ("payload", pa.binary()),
]


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, planes: str = "byte") -> None:
    """Encode ``docs`` (doc_id, text) and write them to ``path`` in ascending order of doc_id.

    Null texts are empty; every document ends with id 1. Equal doc_ids stay side
    by side, ordered by their text's hash; null doc_ids come first. Other columns
    are left out; an empty table gives files without segments. Documents are
    spread by ranges of (doc_id, hash), so no id, source or text is one task's alone
    unless rows are equal in both.
    """
    tokenizer = tokenizer or tokenizer_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("__h"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "doc_id", "__h").sortWithinPartitions("doc_id", "__h")
    ordered.select("doc_id", "text").mapInArrow(lambda b: _segments(b, tokenizer, planes), SEGMENTS).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_segment(row["chunk_ids"], row["plane_ends"], row["payload"], row["planes"])
            raw, ends = ids.tobytes(), row["doc_ends"]
            starts = [0, *ends[:-1]]
            n = len(ends)
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([row["shard"]] * n, pa.int32()),
                    "segment": pa.array([row["segment"]] * n, pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array([b - a for a, b in zip(starts, ends)], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends)], pa.int64()),
                }
            )


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(path)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, segment, base): ids of all segments before each one.

    Totals per shard are one row for each task that wrote, so the window over
    them is small at any size; within a shard the window is the shard's own.
    """
    index = read_segments(spark, path).select("shard", "segment", "n_ids")
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.coalesce(
        F.sum("n_ids").over(Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    return index.join(shards.select("shard", before.alias("__b")), "shard").select(
        "shard", "segment", (F.col("__b") + within).alias("base")
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens and the checksum of its decoded ids."""
    rows = read_segments(spark, path).mapInArrow(_documents, _READ)
    return rows.join(segment_starts(spark, path), ["shard", "segment"]).select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_segment(row["chunk_ids"], row["plane_ends"], row["payload"], row["planes"]).astype(np.int32)
            cut = np.split(ids, row["doc_ends"][:-1]) if row["doc_ends"] else []
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.array(row["doc_ids"], pa.int64()), "ids": pa.array(cut, pa.list_(pa.int32()))}
            )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of the files."""
    return read_segments(spark, path).mapInArrow(_ids, "doc_id long, ids array<int>")
