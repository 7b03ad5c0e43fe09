"""Positions in an ordered table without a single-task window.

Every position below is exact for any distribution of keys. Groups that are
small enough for one task use a plain window; otherwise rows are range
partitioned on (group, order) so that a hot group spreads over many
partitions, and each partition starts from the summed totals of the ones
before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmeter.session import at_most, stored

# Largest group one window task may sort. Above it, rows are segmented.
MAX_GROUP_ROWS = 1_000_000
# Largest per-key table that is sent to every executor.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 128 << 20
# Copies of a per-clip row in the salted join used above that size.
SALTS = 64

# Keys that part the rows in one round of ``key_at``, and keys that are looked at in the end.
SPLITS, LEAF = 64, 10_000

_ROW_BITS = 33  # monotonically_increasing_id keeps the row offset in the low 33 bits


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group; reads the key columns only."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def global_index(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """0-based position of each row in the total order of ``order``.

    ``order`` must be unique. One range shuffle; the row count of each range
    partition is the only thing that is combined across tasks.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = stored(ranged, "global-index").select(
        "*",
        F.shiftright("_mid", _ROW_BITS).alias("_seg"),
        F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_pos"),
    )
    # one row per range partition, so this window and broadcast are bounded
    before = Window.partitionBy(F.lit(0)).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_seg")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_seg", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return (
        ranged.join(F.broadcast(starts), "_seg")
        .withColumn(name, F.col("_start") + F.col("_pos"))
        .drop("_seg", "_pos", "_start", "_mid")
    )


def prefix_sums(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Adds, per group, the sum of each expression over all earlier rows.

    ``order`` must be unique within a group. The size of the largest group is
    checked first: up to ``max_group_rows`` one window per group does it.
    Beyond that, rows are range partitioned on (group, order), summed inside
    (partition, group), and the parts that continue a group from an earlier
    partition get that group's total so far.
    """
    group, order = list(group), list(order)
    df = df.select("*", *[value.alias(f"_v_{name}") for name, value in sums.items()])
    values = [f"_v_{name}" for name in sums]

    def before(*keys: str):
        return (
            Window.partitionBy(*keys)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, -1)
        )

    def running(name: str, *keys: str) -> Column:
        return F.coalesce(F.sum(f"_v_{name}").over(before(*keys)), F.lit(0))

    if largest_group(df, group) <= max_group_rows:
        return df.select("*", *[running(n, *group).alias(n) for n in sums]).drop(*values)

    ranged = stored(
        df.repartitionByRange(*group, *order).withColumn("_seg", F.spark_partition_id()),
        "prefix-sums",
    )
    totals = ranged.groupBy(*group, "_seg").agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy(*group).orderBy("_seg")
    until_now = earlier.rowsBetween(Window.unboundedPreceding, -1)
    # Ranges are sorted by group, so a partition continues at most one group:
    # no more rows than range partitions are left after this filter.
    carried = (
        totals.withColumn("_part", F.row_number().over(earlier))
        .select(*group, "_seg", "_part", *[F.sum(v).over(until_now).alias(f"_c{v}") for v in values])
        .where("_part > 1")
        .drop("_part")
    )
    return (
        ranged.select("*", *[running(n, *group, "_seg").alias(n) for n in sums])
        .join(F.broadcast(carried), [*group, "_seg"], "left")
        .withColumns({n: F.col(n) + F.coalesce(F.col(f"_c_v_{n}"), F.lit(0)) for n in sums})
        .drop("_seg", *values, *[f"_c{v}" for v in values])
    )


def dense_index(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "sample_no",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """0-based position of each row inside its group."""
    return prefix_sums(df, group, order, {name: F.lit(1).cast("bigint")}, max_group_rows)


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(None if value is None else value[f.name], f.dataType).alias(f.name) for f in kind])
    return F.lit(value).cast(kind)


class _Keys:
    """Rows of ``df`` between order keys, as filters that reach the scan."""

    def __init__(self, df: DataFrame, order: Sequence[str]):
        self.df, self.order = df, list(order)
        self.kinds = [df.schema[c].dataType for c in order]
        self.key = F.struct(*self.order)

    def literal(self, key: Row) -> Column:
        return F.struct(*[_literal(v, k).alias(c) for v, k, c in zip(key, self.kinds, self.order)])

    def between(self, low: Row | None, high: Row | None) -> Column:
        """``low <= key < high``; nulls come first. A bound on the first column alone can be pushed into the scan."""
        first, simple = F.col(self.order[0]), not isinstance(self.kinds[0], T.StructType)
        kept = F.lit(True)
        if low is not None:
            kept = kept & (self.key >= self.literal(low))
            if simple and low[0] is not None:
                kept = kept & (first >= _literal(low[0], self.kinds[0]))
        if high is not None:
            kept = kept & (self.key < self.literal(high))
            if simple and high[0] is not None:
                # nulls are before every bound
                kept = kept & (first.isNull() | (first <= _literal(high[0], self.kinds[0])))
        return kept

    def rows(self, low: Row | None, high: Row | None) -> DataFrame:
        return self.df.select(*self.order).where(self.between(low, high))


def key_at(df: DataFrame, order: Sequence[str], position: int) -> Row | None:
    """The order key of the row at ``position`` (0-based); None when there are not so many rows.

    Rounds of counting instead of a sort: some keys of the rows in question, picked by hash, part them, each task
    counts the rows before every one, and the part that holds the position is parted again. A round is one
    pass over the order columns of what is left, without a shuffle of rows; each leaves about a
    ``SPLITS``-th, until ``LEAF`` keys can be looked at. ``order`` must be unique.
    """
    keys = _Keys(df, order)
    low = high = None
    left, size = position, None
    while size is None or size > LEAF:
        rows = keys.rows(low, high)
        picked = rows.orderBy(F.xxhash64(*keys.order), *keys.order).limit(SPLITS)
        marks = picked.distinct().orderBy(*keys.order).collect()
        before = [F.count_if(keys.key < keys.literal(m)).alias(f"n{i}") for i, m in enumerate(marks)]
        *counts, total = rows.agg(*before, F.count(F.lit(1)).alias("total")).first()
        if left >= total:
            return None
        starts = [0, *counts, total]
        i = max(i for i, n in enumerate(starts[:-1]) if n <= left)
        new = (marks[i - 1] if i else low, marks[i] if i < len(marks) else high)
        if new == (low, high):
            raise ValueError(f"{', '.join(order)} is not unique")
        (low, high), size, left = new, starts[i + 1] - starts[i], left - starts[i]
    found = keys.rows(low, high).orderBy(*keys.order).limit(left + 1).collect()  # LEAF keys at most
    return found[left]


def range_slice(
    df: DataFrame, order: Sequence[str], start: int | None = None, end: int | None = None
) -> DataFrame:
    """Rows at positions ``start <= idx < end``; both ends are clamped to the table.

    The keys at both ends are found by counting (``key_at``), so the rest of the table is neither
    sorted nor written; only the slice itself is, to number it.
    """
    start = max(0, start or 0)
    if end is not None and max(0, end) <= start:
        return global_index(df.where(F.lit(False)), order)
    low = key_at(df, order, start) if start else None
    if start and low is None:
        return global_index(df.where(F.lit(False)), order)
    high = key_at(df, order, end) if end is not None else None
    inside = global_index(df.where(_Keys(df, order).between(low, high)), order)
    return inside.withColumn("idx", F.col("idx") + F.lit(start))


def seeded_shuffle(df: DataFrame, key: str, seed: int = 2025) -> DataFrame:
    """A repeatable pseudo-random order: by digest of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("shuffle_key", digest).orderBy("shuffle_key", key)


def limit_run(df: DataFrame, order: Sequence[str], checkpoint_every: int = 50) -> DataFrame:
    """The rows of a trial run: one checkpoint's worth and 50 more."""
    return df.orderBy(*order).limit(checkpoint_every + 50)


def attach(
    rows: DataFrame,
    per_key: DataFrame,
    on: str,
    spread: Column,
    how: str = "inner",
    store: bool = True,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join many rows per key to one row per key, whatever the key's share.

    The small side is broadcast only after its size was checked; ``store``
    writes it down first, so that a computed one is not computed again for
    the check. Beyond that size,
    both sides are salted: ``spread`` (an integer that varies inside a key,
    such as the frame number) picks one of ``SALTS`` copies of the per-key row,
    so a key that holds a third of the table is shared by that many tasks.
    """
    if store:
        per_key = stored(per_key, "per-key")
    if at_most(per_key, max_broadcast_rows, MAX_BROADCAST_BYTES):
        return rows.join(F.broadcast(per_key), on, how)
    salted = rows.withColumn("_salt", F.pmod(spread.cast("bigint"), F.lit(SALTS)).cast("int"))
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [on, "_salt"], how).drop("_salt")
