"""Substring deduplication by content-defined chunks with a gear rolling hash.

A text is cut into chunks of whole words: before a word, where the gear hash of
the 16 bytes up to it is below a limit. Cuts depend on those bytes alone, so text
that is inserted or taken out moves no cut beyond the next few words. A chunk is
a handful of words, which says little when it repeats; so each chunk is digested
together with as many of the chunks after it as it takes to have
``LEAST_WORDS`` words, and these variable chunks, which overlap, are what is
deduplicated. Two equal ones are a passage of at least so many words that occurs twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmeter.llm.common import kept_on_disk
from reelmeter.session import task_count

#: Words that a digested chunk has at least.
LEAST_WORDS = 16
#: A document repeats when a run of repeated chunks has so many words.
LEAST_RUN = 20
#: Mean words between cuts; a passage of 51 words holds a whole chunk in all but one of a thousand cases.
MEAN_WORDS = 3


def _gear_table() -> np.ndarray:
    """256 fixed 16-bit numbers, by a rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40)).astype(np.uint16)


GEAR = _gear_table()
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after every byte: h = 2 h + GEAR[byte], modulo 2**16, so 16 bytes matter."""
    h = GEAR[data]
    for k in (1, 2, 4, 8):  # sums over twice as many bytes each time
        h[k:] += h[:-k] << np.uint16(k)
    return h


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, byte after the last) of every word."""
    blank = _SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]])))
    return edges[::2], edges[1::2]


def chunks(text: str | None, least_words: int = LEAST_WORDS, mean_words: int = MEAN_WORDS):
    """(number of words, first word, words, digest) of the chunks; the last three are arrays."""
    raw = (text or "").encode("utf-8")
    data = np.frombuffer(raw, np.uint8)
    starts, ends = word_bounds(data)
    n = len(starts)
    none = np.zeros(0, np.int32)
    if n < least_words:
        return n, none, none, np.zeros(0, np.int64)
    h = gear(data)
    # the byte before a word is white space, so the hash takes in the word before
    cut = h[starts[1:] - 1] < np.uint16(65535 // mean_words)
    cuts = np.concatenate([[0], np.flatnonzero(cut) + 1, [n]])
    last = np.searchsorted(cuts, cuts[:-1] + least_words, "left")
    whole = last < len(cuts)
    first, stop = cuts[:-1][whole], cuts[last[whole]]
    view, digest = memoryview(raw), xxhash.xxh3_64_intdigest
    found = [digest(view[a:b]) for a, b in zip(starts[first].tolist(), ends[stop - 1].tolist())]
    return n, first.astype(np.int32), (stop - first).astype(np.int32), np.array(found, np.uint64).view(np.int64)


def _chunked(batches: Iterator[pa.RecordBatch], least_words: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("first", pa.int32()), ("words", pa.int32()), ("digest", pa.int64())]
    )
    for batch in batches:
        sizes, parts, held = [], [], 0
        ids = batch["doc_id"]
        begun = 0

        def out(stop):
            counts = np.array([len(p[0]) for p in parts])
            # one row without a chunk for every document, then its chunks
            rows = np.repeat(np.arange(begun, stop), counts)
            docs = pa.concat_arrays([ids.slice(begun, stop - begun), ids.take(pa.array(rows))])
            nothing = pa.nulls(len(parts), pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    docs,
                    pa.concat_arrays([pa.array(sizes, pa.int64()), pa.nulls(len(rows), pa.int64())]),
                    pa.concat_arrays([nothing, pa.array(np.concatenate([p[0] for p in parts]), pa.int32())]),
                    pa.concat_arrays([nothing, pa.array(np.concatenate([p[1] for p in parts]), pa.int32())]),
                    pa.concat_arrays([pa.nulls(len(parts), pa.int64()), pa.array(np.concatenate([p[2] for p in parts]))]),
                ],
                schema=schema,
            )

        for row, text in enumerate(batch["text"]):
            n, *part = chunks(text.as_py(), least_words)
            sizes.append(n)
            parts.append(part)
            held += len(part[0])
            if held > 200_000:
                yield out(row + 1)
                sizes, parts, held, begun = [], [], 0, row + 1
        if parts:
            yield out(len(ids))


_ROWS = "doc_id long, n_words long, first int, words int, digest long"

#: A digest with more than this share of all chunks is hot; there are fewer of those than one over it.
HOT_SHARE = 1 / 1_000


def hot_digests(found: DataFrame) -> list[int]:
    """Digests that hold more than ``HOT_SHARE`` of the chunks, and perhaps some that hold little less.

    A sketch of frequent items per task, merged by aggregation: it bounds what a task and the driver hold, and
    an item whose share is above its error is never missed. Only the column of digests is read.
    """
    most = int(2 / HOT_SHARE)
    row = found.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(digest, {most}, {10 * most})").alias("top")).first()
    return [x["item"] for x in row["top"] or [] if x["count"] > HOT_SHARE * row["n"]]


def _twice(found: DataFrame) -> DataFrame:
    """Digests that occur more than once, with the first occurrence and the largest doc_id."""
    # ``words`` is named so that this reads the columns that the join reads, and shares its exchange
    twice = found.groupBy("digest").agg(
        F.count("words").alias("n"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "first")).alias("one"),
        F.max("doc_id").alias("most"),
    )
    return twice.where("n > 1")


def repeated_chunks(rows: DataFrame) -> DataFrame:
    """Chunks of ``rows`` that occur more than once: doc_id, first, words, digest, is_first, other.

    ``is_first`` marks the occurrence of the smallest (doc_id, first); ``other``
    is the smallest doc_id of the chunk, or for that document the largest one.
    ``rows`` should be a stored table. Chunks are shuffled by digest once, for
    the count and the join back. Hot digests stay where they are: their counts are
    combined before the shuffle, and a row for each of them is broadcast.
    """
    found = rows.where("digest IS NOT NULL").select("doc_id", "first", "words", "digest")
    hot = hot_digests(found)
    is_hot = F.col("digest").isin(hot) if hot else F.lit(False)
    dealt = found.where(~is_hot).repartition(task_count(rows.sparkSession), "digest")
    joined = dealt.join(_twice(dealt).hint("merge"), "digest")
    if hot:
        few = found.where(is_hot)
        joined = joined.unionByName(few.join(F.broadcast(_twice(few)), "digest"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "first") == F.col("one")
    other = F.when(F.col("one.doc_id").eqNullSafe(F.col("doc_id")), F.col("most")).otherwise(F.col("one.doc_id"))
    return joined.select("doc_id", "first", "words", "digest", first.alias("is_first"), other.alias("other"))


def _covered(spans):
    """(words covered, words of the longest run) of an array of (first, end) in order; runs may touch."""
    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("run"), F.lit(0).alias("longest"), F.lit(-1).alias("end"))

    def step(s, x):
        more = F.greatest(F.lit(0), x["end"] - F.greatest(x["first"], s["end"]))
        run = F.when(x["first"] <= s["end"], s["run"] + more).otherwise(more)
        return F.struct(
            (s["n"] + more).alias("n"), run.alias("run"),
            F.greatest(s["longest"], run).alias("longest"), F.greatest(s["end"], x["end"]).alias("end"),
        )

    return F.aggregate(spans, nothing, step, lambda s: F.struct(s["n"].alias("n"), s["longest"].alias("longest")))


def substring_repeats(docs: DataFrame, least_words: int = LEAST_WORDS, least_run: int = LEAST_RUN) -> DataFrame:
    """Per doc_id: n_words, n_repeated_words, longest_run, n_removed_words, repeated, shares_with.

    Words are parts between ASCII white space. Repeated words are those in chunks
    that occur twice or more, in the same or another document; removed words leave out
    what is the first occurrence. ``repeated`` is whether a run of repeated words has
    ``least_run`` words; ``shares_with`` lists, for such documents, the other ids found
    (the smallest of each chunk, or the largest for the document that is the smallest; where
    a passage begins, chunks depend on the words before it and may join some of its documents only).
    An empty table gives an empty one; texts of any length are chunked whole. Rows of equal doc_id are one document here, a null doc_id is an id of its own;
    null and empty texts have no words, texts below ``least_words`` no chunk. Other
    columns are left out.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows, _ = kept_on_disk(source.mapInArrow(lambda b: _chunked(b, least_words), _ROWS), "chunks")
    span = F.struct("first", (F.col("first") + F.col("words")).alias("end"))
    per_doc = repeated_chunks(rows).groupBy("doc_id").agg(
        F.array_sort(F.collect_list(span)).alias("all"),
        F.array_sort(F.collect_list(F.when(~F.col("is_first"), span))).alias("later"),
        F.array_sort(F.collect_set(F.when(~F.col("other").eqNullSafe(F.col("doc_id")), F.col("other")))).alias("others"),
    )
    found = per_doc.select("doc_id", _covered(F.col("all")).alias("a"), _covered(F.col("later")).alias("l"), "others")
    sizes = rows.where("digest IS NULL").groupBy("doc_id").agg(F.sum("n_words").alias("n_words"))
    joined = sizes.alias("s").join(found.alias("f"), F.col("s.doc_id").eqNullSafe(F.col("f.doc_id")), "left")
    run = F.coalesce(F.col("a.longest"), F.lit(0))
    return joined.select(
        "s.doc_id",
        "n_words",
        F.coalesce(F.col("a.n"), F.lit(0)).cast("long").alias("n_repeated_words"),
        run.cast("long").alias("longest_run"),
        F.coalesce(F.col("l.n"), F.lit(0)).cast("long").alias("n_removed_words"),
        (run >= least_run).alias("repeated"),
        F.when(run >= least_run, F.col("others")).otherwise(F.expr("cast(array() as array<bigint>)")).alias("shares_with"),
    )


def cut(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` without the words of (first, words, digest) whose digest it really has there."""
    raw = text.encode("utf-8")
    starts, ends = word_bounds(np.frombuffer(raw, np.uint8))
    gone = np.zeros(len(starts), bool)
    for first, words, digest in spans:
        if first + words <= len(starts):
            here = raw[starts[first] : ends[first + words - 1]]
            if np.uint64(xxhash.xxh3_64_intdigest(here)).view(np.int64) == digest:
                gone[first : first + words] = True
    kept, at = [], 0
    for i in np.flatnonzero(gone).tolist():  # a word goes with the white space before it
        kept.append(raw[at : ends[i - 1] if i else 0])
        at = ends[i]
    return b"".join([*kept, raw[at:]]).decode("utf-8")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            t if t is None or not s else cut(t, [(x["first"], x["words"], x["digest"]) for x in s])
            for t, s in zip(batch["text"].to_pylist(), batch["__spans"].to_pylist())
        ]
        columns = dict(zip(batch.schema.names, batch.columns))
        columns["text"] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_pydict(columns)


def dedup_substrings(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with all but the first occurrence of repeated chunks cut out of ``text``; all columns and rows stay."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows, _ = kept_on_disk(source.mapInArrow(lambda b: _chunked(b, least_words), _ROWS), "chunks")
    spans = repeated_chunks(rows).where("NOT is_first").groupBy(F.col("doc_id").alias("__id"))
    spans = spans.agg(F.collect_set(F.struct("first", "words", "digest")).alias("__spans"))
    joined = docs.join(spans, docs["doc_id"].eqNullSafe(F.col("__id")), "left").drop("__id")
    return joined.mapInArrow(_cut, joined.schema).drop("__spans")
