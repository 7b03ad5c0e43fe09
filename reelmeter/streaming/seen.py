"""Which ids have been handled, without reading what was stored for them.

Ids are dealt by hash into buckets. Each bucket has a Bloom filter of fixed
size, and its ids lie in a folder of their own. A batch asks the filters first:
most new ids are in none, and then nothing else is read. Only buckets
in which a filter says "perhaps" are opened, and only their ids are compared.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmeter.session import discard, exists, task_count

SLICE = 1 << 15  # bits of Spark's bitmap aggregates
#: Bytes of all filters together, which every executor gets.
MOST_BYTES = 64 << 20


@dataclass(frozen=True)
class SeenIds:
    """An index of ids under ``root``; sizes are fixed when it is begun.

    Filters take ``buckets * bits / 8`` bytes, whatever the number of ids or batches. With ten bits an
    id, one new id in a hundred opens its bucket for nothing; with fewer, more do, and results stay right.
    Every ``merge_every`` batches the small files of the last ones become one file a bucket.
    """

    root: str
    buckets: int = 64
    bits: int = 1 << 18
    hashes: int = 4
    merge_every: int = 16

    def __post_init__(self):
        if self.bits % SLICE or self.buckets * self.bits // 8 > MOST_BYTES:
            raise ValueError(f"bits must be a multiple of {SLICE}, and filters not larger than {MOST_BYTES} bytes")

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit("bucket"), key), F.lit(self.buckets)).cast("int")

    def _positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(self.bits)).cast("int") for i in range(self.hashes)]

    def _filters(self, batch_id: int) -> str:
        return f"{self.root}/filters/batch_id={batch_id}"

    def _ids(self, batch_id: int) -> str:
        return f"{self.root}/ids/batch_id={batch_id}"

    def _merged(self, stop: int) -> str:
        return f"{self.root}/merged/stop={stop}"

    def _folders(self, spark: SparkSession, batch_id: int) -> list[str]:
        """Where the ids of batches before ``batch_id`` are: one folder for every ``merge_every`` of them, and the rest."""
        whole = batch_id // self.merge_every * self.merge_every
        merged = [self._merged(stop) for stop in range(self.merge_every, whole + 1, self.merge_every)]
        return [p for p in merged + [self._ids(n) for n in range(whole, batch_id)] if exists(spark, p)]

    def perhaps(self, rows: DataFrame, key: str, batch_id: int) -> DataFrame:
        """``rows`` with ``_bucket`` and ``_perhaps``: false where no earlier batch can have stored the id."""
        spark = rows.sparkSession
        rows = rows.withColumn("_bucket", self._bucket(F.col(key)))
        if batch_id == 0 or not exists(spark, self._filters(batch_id - 1)):
            return rows.withColumn("_perhaps", F.lit(False))
        filters = spark.read.parquet(self._filters(batch_id - 1)).withColumnRenamed("bucket", "_bucket")
        # of a fixed size, checked when the index is begun
        joined = rows.join(F.broadcast(filters), "_bucket", "left")

        def is_set(position: Column) -> Column:
            bits = F.element_at("slices", F.floor(position / SLICE).cast("int"))
            at = F.pmod(position, F.lit(SLICE))
            byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
            return F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8))) == 1, F.lit(False))

        every = F.lit(True)
        for position in self._positions(F.col(key)):
            every = every & is_set(position)
        return joined.withColumn("_perhaps", F.col("slices").isNotNull() & every).drop("slices")

    def unseen(self, rows: DataFrame, key: str, batch_id: int) -> DataFrame:
        """``rows`` whose id no batch before ``batch_id`` added; null ids count as never seen."""
        spark = rows.sparkSession
        if batch_id and batch_id % self.merge_every == 0:
            self._merge(spark, batch_id)
        asked = self.perhaps(rows, key, batch_id)
        # at most as many numbers as there are buckets
        touched = [r[0] for r in asked.where("_perhaps").select("_bucket").distinct().collect()]
        asked = asked.drop("_perhaps", "_bucket")
        folders = self._folders(spark, batch_id) if touched else []
        if not folders:
            return asked
        opened = [f"{folder}/bucket={b}" for folder in folders for b in touched]
        opened = [p for p in opened if exists(spark, p)]
        if not opened:
            return asked
        return asked.join(spark.read.parquet(*opened).select("id").withColumnRenamed("id", key), key, "left_anti")

    def add(self, ids: DataFrame, key: str, batch_id: int) -> None:
        """Add the ids of a batch. A batch that is replayed replaces what it added, since it reads earlier ones only."""
        spark = ids.sparkSession
        rows = ids.where(F.col(key).isNotNull()).select(F.col(key).alias("id")).distinct()
        rows = rows.withColumn("bucket", self._bucket(F.col("id")))
        tasks = min(self.buckets, task_count(spark))
        rows.repartition(tasks, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._ids(batch_id))
        if not exists(spark, self._ids(batch_id)):
            return
        stored = spark.read.schema(rows.schema).parquet(self._ids(batch_id))
        each = stored.select("bucket", F.explode(F.array(*self._positions(F.col("id")))).alias("position"))
        bits = each.groupBy("bucket", F.floor(F.col("position") / SLICE).cast("int").alias("slice")).agg(
            F.bitmap_construct_agg(F.pmod("position", F.lit(SLICE))).alias("bits")
        )
        if batch_id and exists(spark, self._filters(batch_id - 1)):
            before = spark.read.parquet(self._filters(batch_id - 1)).select("bucket", F.explode("slices").alias("slice", "bits"))
            bits = bits.unionByName(before).groupBy("bucket", "slice").agg(F.bitmap_or_agg("bits").alias("bits"))
        # a bucket has bits / SLICE slices
        filters = bits.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("slice", "bits"))).alias("slices"))
        filters.coalesce(1).write.mode("overwrite").parquet(self._filters(batch_id))
        if batch_id > 1:
            discard(spark, self._filters(batch_id - 2))  # a replay needs those of the batch before

    def _merge(self, spark: SparkSession, stop: int) -> None:
        """Once batch ``stop`` has begun, those before it are not replayed any more and can be put together."""
        if exists(spark, f"{self._merged(stop)}/_SUCCESS"):
            return
        small = [p for n in range(stop - self.merge_every, stop) if exists(spark, p := self._ids(n))]
        if not small:
            return
        rows = spark.read.option("basePath", f"{self.root}/ids").parquet(*small).select("id", "bucket")
        tasks = min(self.buckets, task_count(spark))
        rows.repartition(tasks, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._merged(stop))
        discard(spark, *small)
