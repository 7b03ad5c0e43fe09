"""Vector best-fit packing of token pieces into training sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum
of squared piece lengths, what block-wise attention costs). A piece goes into
the open sequence that scores best among those that can hold it under every
capacity: by the weighted dot product of demand and residual, or by the norm of
what would be left. Pieces are taken longest first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmeter.llm.common import kept_on_disk
from reelmeter.llm.tokens import tokenizer_path, word_tokens

#: Pieces that one task packs together. More would save a fraction of one sequence per task.
PER_TASK = 8192

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, the weights of the three dimensions, and the way to choose.

    ``rule`` is "norm" (least weighted residual norm) or "dot" (largest weighted
    dot product of demand and residual). ``cost`` defaults to the cost of one
    whole sequence, which any set of pieces within ``tokens`` keeps.
    """

    tokens: int = 4096
    documents: int = 4096
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"

    @property
    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.cost or self.tokens**2], float)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every piece; pieces longer than a sequence's tokens are refused.

    A piece that would break a capacity even alone in a sequence (a cost limit
    below its own cost) gets a sequence of its own.
    """
    if len(lengths) and lengths.max() > capacity.tokens:
        raise ValueError("a piece is longer than a sequence")
    full, weights = capacity.vector, np.array(capacity.weights)
    order = np.argsort(-lengths, kind="stable")
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    left = np.zeros((len(lengths), 3))  # residuals of open sequences
    names = np.zeros(len(lengths), np.int64)
    n_open = n_bins = 0
    for i in order:
        size = int(lengths[i])
        need = np.array([size, 1, size * size], float)
        room = left[:n_open]
        fits = np.flatnonzero((room >= need).all(axis=1))
        if len(fits):
            if capacity.rule == "norm":
                score = -((((room[fits] - need) / full) ** 2) @ weights)
            else:
                score = (room[fits] / full) @ (weights * need / full)
            k = int(fits[np.argmax(score)])
        else:
            k, n_open = n_open, n_open + 1
            left[k], names[k] = full, n_bins
            n_bins += 1
        bins[i], offsets[i] = names[k], capacity.tokens - int(left[k, 0])
        left[k] -= need
        if left[k].min() < 1:  # nothing fits any more
            n_open -= 1
            left[k], names[k] = left[n_open], names[n_open]
    return bins, offsets


def _pieces(batches: Iterator[pa.RecordBatch], path: str, longest: int) -> Iterator[pa.RecordBatch]:
    tokens = word_tokens(path)
    for batch in batches:
        for first, ids, ends in tokens.documents(batch):
            raw, at = memoryview(ids.astype("<u4").tobytes()), 0
            rows, numbers, starts, sizes, sums = [], [], [], [], []
            for row, end in enumerate(ends.tolist(), first):
                for number, start in enumerate(range(at, end, longest)):
                    stop = min(start + longest, end)
                    rows.append(row)
                    numbers.append(number)
                    starts.append(start - at)
                    sizes.append(stop - start)
                    sums.append(zlib.crc32(raw[4 * start : 4 * stop]))
                at = end
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(rows, pa.int64())),
                    pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )


def pieces(docs: DataFrame, longest: int = 4096, tokenizer: str | None = None) -> DataFrame:
    """Pieces of at most ``longest`` ids of every document (doc_id, text); each document ends with id 1."""
    path = tokenizer or tokenizer_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda b: _pieces(b, path, longest), PIECES)


def _packed(batches: Iterator[pa.RecordBatch], capacity: Capacity) -> Iterator[pa.RecordBatch]:
    held = pa.Table.from_batches(batches) if (batches := list(batches)) else None
    if held is None or not held.num_rows:
        return
    bins, offsets = best_fit(held["length"].to_numpy(), capacity)
    task = TaskContext.get().partitionId() << 32
    out = held.append_column("sequence_id", pa.array(task + bins, pa.int64()))
    yield from out.append_column("offset", pa.array(offsets, pa.int64())).to_batches(max_chunksize=10_000)


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), per_task: int = PER_TASK) -> DataFrame:
    """``pieces`` (any columns with ``length``) with ``sequence_id`` and ``offset``.

    Pieces are dealt evenly, without a key, to tasks of about ``per_task``, so
    hot documents or sources do not matter and what a task holds is bounded.
    ``pieces`` should be a stored table: it is counted first. Only the last
    sequences of each task stay partly empty. Ids of sequences are unique, not
    consecutive; an empty table stays empty.
    """
    tasks = 1 + pieces.count() // per_task
    schema = pieces.selectExpr("*", "0L AS sequence_id", "0L AS offset").schema
    return pieces.repartition(tasks).mapInArrow(lambda b: _packed(b, capacity), schema)


def pack_documents(docs: DataFrame, capacity: Capacity = Capacity(), tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents with their places.

    An empty table gives an empty one; texts of any length are cut into pieces of a whole sequence, and pieces of equal
    length are taken in the order in which they arrive. Null and empty texts are a piece with the end id alone. Repeated rows and
    equal doc_ids are packed like any others, null doc_ids stay null, other
    columns are left out.
    """
    return pack(kept_on_disk(pieces(docs, capacity.tokens, tokenizer), "pieces")[0], capacity)


def _tokens(batches: Iterator[pa.RecordBatch], path: str, longest: int) -> Iterator[pa.RecordBatch]:
    tokens = word_tokens(path)
    for batch in batches:
        for first, ids, ends in tokens.documents(batch):
            at = 0
            for row, end in enumerate(ends.tolist(), first):
                cuts = range(at, end, longest)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([batch["doc_id"][row].as_py()] * len(cuts), pa.int64()),
                        "piece": pa.array(range(len(cuts)), pa.int32()),
                        "ids": pa.array([ids[c : min(c + longest, end)].astype(np.int32) for c in cuts], pa.list_(pa.int32())),
                    }
                )
                at = end


def sequences(docs: DataFrame, packed: DataFrame, longest: int = 4096, tokenizer: str | None = None) -> DataFrame:
    """The sequences themselves: sequence_id, ids and the first position of each piece.

    ``doc_id`` must be unique here, since it leads from a place back to the text.
    A sequence gathers at most ``longest`` ids.
    """
    path = tokenizer or tokenizer_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = rows.mapInArrow(lambda b: _tokens(b, path, longest), "doc_id long, piece int, ids array<int>")
    parts = packed.join(ids, ["doc_id", "piece"]).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("starts"))
