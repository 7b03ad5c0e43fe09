"""N-gram Jaccard join with a token-group matrix.

Documents are sets of word shingles; two link when their Jaccard similarity
reaches a limit. Equal sets are one class. Classes that are likely to be similar
(same smallest hash) form groups of bounded size, and the matrix says which tokens
the members of a group have. A query document can only link with a member if
the group's token union holds the limit's share of its own tokens, so first the
groups are found that share a rare token with it, then the overlap with their union
bounds what a member could reach, and only groups that pass are opened. For the
bounds, sets and unions are bitmaps of hashed tokens: a token whose bit is missing is
surely lacking, so the bounds let all links through. What passes is compared by whole sets.

The rare tokens of a document are as many as it could lack in a partner, plus
one, in an order that all documents share (rarest first by a count sketch, then
by hash): two documents that link have one of them in common. So no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmeter.llm.common import arrow_rows, discard, free_name, kept_on_disk
from reelmeter.llm.components import components

#: Buckets of the count sketch (two to the power of it); slices in which it travels.
SKETCH_BITS, SLICES = 20, 64
#: What a group holds, about: documents and tokens.
GROUP_DOCS, GROUP_TOKENS = 48, 100_000
#: Texts that a task gets at a time.
TEXT_ROWS = 1_000

#: A-Z lower-cased, other bytes as they are; white space is what ``bytes.split`` knows.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: str | None, size: int = 3) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of all words when there are fewer than ``size``."""
    words = (text or "").encode("utf-8").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(size, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):  # mixed after each word, so order counts
        out = (out ^ h[j : len(h) - k + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _sketched(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Counts of the task's tokens by bucket, in slices."""
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    held, waiting = 0, []

    def add():
        if waiting:
            buckets = np.concatenate(waiting) >> np.uint64(64 - SKETCH_BITS)
            counts[:] += np.bincount(buckets.astype(np.int64), minlength=len(counts))
            waiting.clear()

    for batch in batches:
        for text in batch["text"]:
            waiting.append(shingle_hashes(text.as_py(), size))
            held += len(waiting[-1])
            if held > 1 << 20:
                add()
                held = 0
    add()
    if counts.any():
        part = TaskContext.get().partitionId() % SLICES
        small = np.minimum(counts, 2**32 - 1).astype("<u4").reshape(SLICES, -1)
        yield pa.RecordBatch.from_pydict(
            {
                "slice": pa.array(range(SLICES), pa.int32()),
                "part": pa.array([part] * SLICES, pa.int32()),
                "counts": pa.array([x.tobytes() for x in small], pa.binary()),
            }
        )


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), "<u4").astype(np.int64) for x in table["counts"])
    total = np.minimum(total, 2**32 - 1).astype("<u4")
    return table.slice(0, 1).set_column(2, "counts", pa.array([total.tobytes()], pa.binary()))


def token_counts(docs: DataFrame, size: int) -> np.ndarray:
    """The count sketch of all tokens of all documents. Its size is fixed; parts are added up in two levels."""
    schema = "slice int, part int, counts binary"
    parts = docs.select("text").mapInArrow(lambda b: _sketched(b, size), schema)
    total = parts.groupBy("slice", "part").applyInArrow(_added, schema).groupBy("slice").applyInArrow(_added, schema)
    out = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), "<u4")
    for row in total.select("slice", "counts").collect():
        out[row["slice"]] = np.frombuffer(row["counts"], "<u4")
    return out.reshape(-1)


def _rare(tokens: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest tokens of a set: one more than a partner may lack."""
    n = len(tokens)
    most = n - -(-percent * n // 100) + 1
    order = np.lexsort((tokens, counts[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))
    return tokens[order[:most]]


_DESCRIBED = "doc_id long, n_shingles long, key binary, least long, bits binary, rare array<long>"


def _described(batches: Iterator[pa.RecordBatch], counts, size: int, percent: int) -> Iterator[pa.RecordBatch]:
    known = counts.value
    for batch in batches:
        sets = [shingle_hashes(t.as_py(), size) for t in batch["text"]]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch["doc_id"],
                "n_shingles": pa.array(map(len, sets), pa.int64()),
                "key": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                "least": pa.array([int(s[0].view(np.int64)) if len(s) else None for s in sets], pa.int64()),
                "bits": pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary()),
                "rare": pa.array(
                    [_rare(s, known, percent).view(np.int64) if len(s) else [] for s in sets], pa.list_(pa.int64())
                ),
            }
        )


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The sets of texts that have the wanted key; of neighbouring rows with the same id and key only one."""
    before, known = None, set()
    for batch in batches:
        sets, same = [], []
        for doc_id, key, text in zip(batch["doc_id"].to_pylist(), batch["key"].to_pylist(), batch["text"]):
            if doc_id != before:
                before, known = doc_id, set()
            s = shingle_hashes(text.as_py(), size)
            sets.append(s)
            same.append(key not in known and xxhash.xxh3_128_digest(s.tobytes()) == key)
            if same[-1]:
                known.add(key)
        same = pa.array(same, pa.bool_())
        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch["doc_id"], "tokens": pa.array([s.tobytes() for s in sets], pa.binary())}
        ).filter(same)


def bitmap(tokens: np.ndarray) -> bytes:
    """Which values the low bits of the tokens take; two to four bits for each token, a power of two."""
    bits = np.zeros(max(64, 1 << (2 * len(tokens) - 1).bit_length()), bool)
    bits[(tokens & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _folded(rows: np.ndarray, length: int) -> np.ndarray:
    """Bitmaps (one a row, of 64-bit words) as they would be with only ``length`` words."""
    if rows.shape[1] == length:
        return rows
    return np.bitwise_or.reduce(rows.reshape(len(rows), -1, length), axis=1)


class Group:
    """The members of a group, by the length of their bitmaps, and the union of their tokens as a bitmap."""

    def __init__(self, members: list[dict]):
        members = sorted(members, key=lambda m: m["doc_id"])
        self.ids = np.array([m["doc_id"] for m in members], np.int64)
        self.sizes = np.array([m["n_shingles"] for m in members], np.int64)
        self.components = np.array([m["component"] for m in members], np.int64)
        self.rows = [np.frombuffer(m["bits"], np.uint64).reshape(1, -1) for m in members]
        lengths = np.array([r.shape[1] for r in self.rows])
        self.by_length = {}
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            self.by_length[n] = at, np.concatenate([self.rows[i] for i in at])
        shortest = int(lengths.min())
        self.union = np.bitwise_or.reduce(np.concatenate([_folded(r, shortest) for r in self.rows]), axis=0, keepdims=True)

    def may_hold(self, row: np.ndarray, size: int, percent: int) -> bool:
        """Whether a query's overlap with the union can reach the share that a partner must have."""
        n = min(row.shape[1], self.union.shape[1])
        lacking = int(np.bitwise_count(_folded(row, n) & ~_folded(self.union, n)).sum())
        return 100 * (size - lacking) >= percent * size

    def partners(self, row: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Members that may link with a query, in order of doc_id: none that does is left out."""
        found = []
        for length, (at, rows) in self.by_length.items():
            n = min(length, row.shape[1])
            own, others, sizes = _folded(row, n), _folded(rows, n), self.sizes[at]
            both = np.minimum(
                size - np.bitwise_count(own & ~others).sum(axis=1, dtype=np.int64),
                sizes - np.bitwise_count(others & ~own).sum(axis=1, dtype=np.int64),
            )
            found.append(at[100 * both >= percent * (size + sizes - both)])
        return np.sort(np.concatenate(found))


def open_groups(one: Group, two: Group, percent: int, first_only: bool) -> Iterator[tuple[int, int]]:
    """(doc_id, doc_id) of members that may link and are not in one component yet.

    Members of ``one`` are the queries. Only if the bound by the union of ``two``
    holds, its members are looked at, again with a bound on the overlap.
    ``first_only`` gives just the first partner of each query.
    """
    same = np.array_equal(one.ids, two.ids)
    for i, row in enumerate(one.rows):
        size = int(one.sizes[i])
        if not two.may_hold(row, size, percent):
            continue
        at = two.partners(row, size, percent)
        if same:
            at = at[at < i]
        at = at[two.components[at] != one.components[i]]
        for j in at[: 1 if first_only else None].tolist():
            yield int(one.ids[i]), int(two.ids[j])


def _opened(batches: Iterator[pa.RecordBatch], percent: int, first_only: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: set[tuple[int, int]] = set()
        for one, two in zip(batch["one"], batch["two"]):
            pairs = open_groups(Group(one.as_py()), Group(two.as_py()), percent, first_only)
            found.update((max(p), min(p)) for p in pairs)
        u, v = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for one, two in zip(batch["one"], batch["two"]):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (one, two))
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            both = int((b[at] == a).sum())
            ok.append(100 * both >= percent * (len(a) + len(b) - both))
        yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))


def _groups(classes: DataFrame) -> DataFrame:
    """``classes`` with ``group``: those with the same least token, dealt by hash where they are many."""
    sizes = classes.groupBy("least").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("tokens"))
    parts = F.greatest(F.ceil(F.col("docs") / GROUP_DOCS), F.ceil(F.col("tokens") / GROUP_TOKENS), F.lit(1))
    joined = classes.join(sizes.select("least", parts.alias("parts")), "least")
    return joined.withColumn("group", F.xxhash64("least", F.pmod(F.xxhash64("doc_id"), F.col("parts")))).drop("parts")


def _met(pairs: DataFrame, members: DataFrame, percent: int, first_only: bool) -> DataFrame:
    """Pairs of documents that may link, of pairs (g1, g2) of groups; what is shuffled are bitmaps."""
    one = members.select(F.col("group").alias("g1"), F.col("members").alias("one"))
    two = members.select(F.col("group").alias("g2"), F.col("members").alias("two"))
    opened = pairs.join(one, "g1").join(two, "g2").select("one", "two")
    found = opened.mapInArrow(lambda t: _opened(t, percent, first_only), "u long, v long")
    return kept_on_disk(found.distinct(), "met")[0]


def _true(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that link, by their whole sets.

    Partners of one document are dealt to parts of about ``GROUP_DOCS``, and each part
    gets one copy of its set: a document with very many partners is no hot key.
    """
    parts = F.ceil(F.col("n") / GROUP_DOCS)
    counts = pairs.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    dealt = pairs.join(counts, "v").select("u", "v", F.pmod(F.xxhash64("u"), parts).alias("part"))
    heads = counts.select("v", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    heads = heads.join(sets.select(F.col("doc_id").alias("v"), F.col("tokens").alias("two")), "v")
    rest = dealt.join(sets.select(F.col("doc_id").alias("u"), F.col("tokens").alias("one")), "u")
    return rest.join(heads, ["v", "part"]).select("u", "v", "one", "two").mapInArrow(
        lambda t: _verified(t, percent), "u long, v long"
    )


def links(docs: DataFrame, described: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (u, v) between classes, named by their smallest doc_id; enough of them to connect what links.

    Two rounds. The first opens each group for itself and for the smallest group
    that has one of its rare tokens, and takes one partner for each document. The second opens
    all other pairs of groups that share a rare token, but for those that lie in one
    component already, where no link could tell anything new.
    """
    spark = docs.sparkSession
    classes = described.where("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"),
        *[F.first(c).alias(c) for c in ("n_shingles", "least", "bits", "rare")],
    )
    grouped, grouped_path = kept_on_disk(_groups(classes), "groups")
    # the matrix: one row for each token and group, of tokens that several groups have
    cells = (
        grouped.select(F.explode("rare").alias("token"), "group", "n_shingles")
        .repartition("token")
        .groupBy("token", "group")
        .agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"))
    )
    hubs = cells.groupBy("token").agg(
        F.min("group").alias("hub"),
        F.max("group").alias("last"),
        F.min_by("least", "group").alias("hub_least"),
        F.min_by("most", "group").alias("hub_most"),
    )
    matrix, matrix_path = kept_on_disk(cells.join(hubs.where("hub < last").drop("last"), "token"), "matrix")
    several, _ = kept_on_disk(
        grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group"), "several"
    )
    # ranges of sizes rule out groups before they meet
    near = (100 * F.col("hub_most") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("hub_least"))
    stars = matrix.where(near & (F.col("group") != F.col("hub"))).select(F.col("group").alias("g1"), F.col("hub").alias("g2"))
    stars = stars.distinct().unionByName(several.select(F.col("group").alias("g1"), F.col("group").alias("g2")))

    wanted = matrix.select("group").unionByName(several).distinct()
    chosen, chosen_path = kept_on_disk(
        grouped.join(wanted, "group", "left_semi").select("group", "doc_id", "key", "n_shingles", "bits"), "chosen"
    )
    ids = chosen.select(F.col("doc_id").alias("__id"), "key")
    texts = docs.join(ids, F.col("doc_id") == F.col("__id")).select("doc_id", "key", "text")
    # rows of one doc_id may differ in text; sets other than the wanted fall out
    discard(spark, grouped_path)  # what follows has what it needs of them
    with arrow_rows(spark, TEXT_ROWS):
        sets, sets_path = kept_on_disk(texts.mapInArrow(lambda t: _sets(t, size), "doc_id long, tokens binary"), "sets")

    def members(parts: DataFrame) -> DataFrame:
        return parts.groupBy("group").agg(
            F.collect_list(F.struct("doc_id", "n_shingles", "bits", "component")).alias("members")
        )

    with arrow_rows(docs.sparkSession, 256):
        alone = chosen.withColumn("component", F.col("doc_id"))
        first, _ = kept_on_disk(_true(_met(stars, members(alone), percent, True), sets, percent), "links")
        found = components(first)
        placed = chosen.join(found, F.col("doc_id") == F.col("node"), "left").withColumn(
            "component", F.coalesce("component", "doc_id")
        )
        placed, placed_path = kept_on_disk(placed.drop("node"), "placed")
        discard(spark, chosen_path)
        spans = placed.groupBy("group").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        cells = matrix.select("token", "group", "least", "most").join(spans, "group")
        a, b = cells.alias("a"), cells.alias("b")
        met = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.group") < F.col("b.group"))
            & (100 * F.col("a.most") >= percent * F.col("b.least")) & (100 * F.col("b.most") >= percent * F.col("a.least"))
            & (F.least("a.low", "b.low") < F.greatest("a.high", "b.high")))
        pairs = met.select(F.col("a.group").alias("g1"), F.col("b.group").alias("g2")).distinct()
        mixed = spans.where("low < high").select(F.col("group").alias("g1"), F.col("group").alias("g2"))
        more = _met(pairs.unionByName(mixed), members(placed), percent, False)
        second, _ = kept_on_disk(_true(more, sets, percent), "links")
        discard(spark, matrix_path, placed_path, sets_path)
    return first.unionByName(second)


def similar_documents(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs``.

    Words are parts between ASCII white space, with A-Z lower-cased; a set has the
    distinct shingles of ``size`` words, or all words as one when there are fewer.
    Null and empty texts have an empty set and link with nothing. Two documents
    link when 100 * |A and B| >= percent * |A or B|; ``component_id`` is the smallest
    doc_id that links lead to. A doc_id names a document: rows that share one may
    be taken as linked. Rows with a null doc_id get a null component. Other columns
    are left out; an empty table gives an empty one. Texts are whole sets, however long; rows with equal sets are one class.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with arrow_rows(spark, TEXT_ROWS):
        counts = spark.sparkContext.broadcast(token_counts(source, size))
        described, path = kept_on_disk(
            source.mapInArrow(lambda b: _described(b, counts, size, percent), _DESCRIBED), "described"
        )
    found = components(links(source, described, size, percent))
    described, _ = kept_on_disk(described.select("doc_id", "n_shingles", "key"), "keys")
    discard(spark, path)
    least = described.where("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"))
    named = least.join(found, F.col("first") == F.col("node"), "left").select(
        F.col("key").alias("__key"), F.coalesce("component", "first").alias("component_id")
    )
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    joined = described.join(named, F.col("key") == F.col("__key"), "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))


def drop_similar(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one row of each component, one with its smallest doc_id, and its columns.

    Rows are numbered first and links are between rows, so rows that share a doc_id
    stay apart where their texts do not link. Of rows with the same doc_id and no
    words one stays; rows with a null doc_id all stay.
    """
    row = free_name(docs.columns, "__row")
    named = docs.where("doc_id IS NOT NULL").withColumn(row, F.monotonically_increasing_id())
    numbered, _ = kept_on_disk(named, "numbered")
    found = similar_documents(numbered.select(F.col(row).alias("doc_id"), "text"), size, percent)
    found = found.withColumnRenamed("doc_id", "__row").join(numbered.select(F.col(row).alias("__row"), "doc_id"), "__row")
    wordless = F.col("n_shingles") == 0
    first = found.groupBy(
        F.when(wordless, F.col("doc_id")).alias("alone"), F.when(~wordless, F.col("component_id")).alias("component")
    ).agg(F.min(F.struct("doc_id", "__row")).alias("first"))
    stay = numbered.join(first.select(F.col("first.__row").alias(row)), row, "left_semi").drop(row)
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where("doc_id IS NULL"))
