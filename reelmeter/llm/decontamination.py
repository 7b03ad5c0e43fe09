"""Benchmark decontamination by Wu-Manber search over word sequences.

An item of the benchmark is a sequence of words; its windows of ``window`` words
(the whole item when it is shorter) are the patterns. The search reads a
document word by word, not letter by letter: a block is two neighbouring words.
The shift table says how far the search may move on after it has looked at the
block at the end of the present position, a block that occurs in no pattern
allows the longest move. A block that ends a pattern leads to the bucket of the
patterns with that suffix, and those are compared directly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmeter.llm.common import free_name, kept_on_disk

#: ASCII other than letters and digits parts words; A-Z is lower-cased.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: Bytes of benchmark text whose tables a task holds at once; tables take up to ninety times as much.
BLOCK_BYTES = 2 << 20

_RESULT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class WuManber:
    """Tables for patterns of one or more lengths; one shift table per length class.

    Short patterns would shorten every move, so patterns are searched in classes
    whose lengths differ by less than a factor of two.
    """

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]]):
        classes: dict[int, list[tuple[bytes, ...]]] = {}
        for p in patterns:
            classes.setdefault(len(p).bit_length(), []).append(p)
        self.patterns = patterns
        self.classes = [self._tables(ps) for ps in classes.values()]

    @staticmethod
    def _tables(patterns: list[tuple[bytes, ...]]):
        m = min(map(len, patterns))
        size = min(2, m)
        shift: dict = {}
        bucket: dict[tuple[bytes, ...], list[tuple[bytes, ...]]] = {}
        for p in patterns:
            for end in range(size, m + 1):
                block = p[end - size : end] if size > 1 else p[end - 1]
                shift[block] = min(shift.get(block, m), m - end)
                if end == m:
                    bucket.setdefault(block, []).append(p)
        return m, size, m - size + 1, shift, bucket

    def occurrences(self, text: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(first word, pattern) of every occurrence."""
        for m, size, longest, shift, bucket in self.classes:
            at, n = m - 1, len(text)
            while at < n:
                block = (text[at - 1], text[at]) if size > 1 else text[at]
                move = shift.get(block, longest)
                if move:
                    at += move
                    continue
                first = at - m + 1
                for p in bucket[block]:
                    if first + len(p) <= n and tuple(text[first : first + len(p)]) == p:
                        yield first, p
                at += 1


def windows(items: Iterable[tuple[str, str | None]], window: int) -> dict[tuple[bytes, ...], list[str]]:
    """Patterns and the items that contain them."""
    found: dict[tuple[bytes, ...], dict[str, None]] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            found.setdefault(tuple(w[i : i + window]), {})[item] = None
    return {p: list(ids) for p, ids in found.items()}


def _merged(spans: Iterable[tuple[int, int]]) -> list[int]:
    """Ends of the union of spans: first, end, first, end, ..."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += (a, b)
    return out


def _searched(batches: Iterator[pa.RecordBatch], tables) -> Iterator[pa.RecordBatch]:
    search = WuManber(tables.value)
    for batch in batches:
        hits, items = [], []
        before = zip(batch.columns[-2].to_pylist(), batch.columns[-1].to_pylist())
        for text, (old_hits, old_items) in zip(batch["text"], before):
            spans, ids = list(zip(*[iter(old_hits)] * 2)), set(old_items)
            for first, p in search.occurrences(words(text.as_py())):
                spans.append((first, first + len(p)))
                ids.update(search.patterns[p])
            hits.append(_merged(spans))
            items.append(sorted(ids))
        found = [pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *found], batch.schema.names)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    block_bytes: int = BLOCK_BYTES,
    then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """``docs`` and, as the last two columns, ``__hits`` (ends of merged word spans) and ``__items`` (ids found, sorted).

    All columns of ``docs`` are kept, ``text`` must be one of them; where one is called as an added
    column, that has underscores behind its name. Texts are searched whole, however long. Benchmark
    items are read in blocks of about ``block_bytes`` of text, so what a task
    holds stays bounded however large the benchmark is; the documents pass by
    once per block, without a shuffle. Null texts and texts without words have
    no hits; items without words or with a null id are no patterns. ``then`` goes on with the
    batches of the last block, to rows of ``schema``, in the same Python process.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("string").alias("item_id"), "text"
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    hits, ids = (free_name(docs.columns, n) for n in ("__hits", "__items"))
    found = docs.withColumns({hits: F.expr("cast(array() as array<int>)"), ids: F.expr("cast(array() as array<string>)")})
    done, plain = then is None, found.schema
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        tables = spark.sparkContext.broadcast(windows(((r.item_id, r.text) for r in part), window))
        if not tables.value:
            continue
        if k + 1 < blocks:
            found = found.mapInArrow(lambda batches, t=tables: _searched(batches, t), plain)
            found = kept_on_disk(found, "decontamination")[0]  # so that no task holds the tables of two blocks
        elif then is None:
            found = found.mapInArrow(lambda batches, t=tables: _searched(batches, t), plain)
        else:
            found, done = found.mapInArrow(lambda batches, t=tables: then(_searched(batches, t)), schema or plain), True
    return found if done else found.mapInArrow(then, schema or plain)


def _hit_words(hits: list[int]) -> int:
    return sum(hits[1::2]) - sum(hits[::2])


def _contaminated(hit: int, n: int) -> bool:
    return hit > 0 and 20 * hit >= n


def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [len(words(t.as_py())) for t in batch["text"]]
        hit = [_hit_words(h) for h in batch.columns[-2].to_pylist()]
        items = batch.columns[-1].to_pylist()
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch["doc_id"],
                "n_words": pa.array(n, pa.int64()),
                "n_hit": pa.array(hit, pa.int64()),
                "n_items": pa.array(map(len, items), pa.int64()),
                "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                "contaminated": pa.array(map(_contaminated, hit, n), pa.bool_()),
            }
        )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """One row per row of ``docs``: words, words hit, items found, whether contaminated.

    A document is contaminated when words are hit and they are at least a
    twentieth of its words. Repeated rows give repeated results, an empty table
    gives an empty one, columns besides ``doc_id`` and ``text`` are left out.
    Texts are searched whole, however long. ``items_sha256`` of a document without items is the digest of the empty string.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return find_benchmark(rows, benchmark, window, then=_verdicts, schema=_RESULT)


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit = map(_hit_words, batch.columns[-2].to_pylist())
        n = (len(words(t.as_py())) for t in batch["text"])
        yield batch.filter(pa.array([not _contaminated(h, k) for h, k in zip(hit, n)], pa.bool_()))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns of ``docs``."""
    found = find_benchmark(docs, benchmark, window, then=_clean)
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
