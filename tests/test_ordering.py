import pytest
from pyspark.sql import functions as F

from reelmeter.operators import ordering


@pytest.fixture()
def hot(spark):
    """A third of the rows belong to one group; keys are spread and out of order."""
    rows = spark.range(0, 3000).select(
        F.when(F.pmod("id", F.lit(3)) == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("g"), F.pmod("id", F.lit(70)))).alias("clip_id"),
        F.pmod(F.col("id") * 7919, F.lit(3001)).alias("k"),
        (F.col("id") * 3).alias("x"),
    )
    return rows.repartition(6)


def expected(rows):
    seen, out = {}, {}
    for r in sorted(rows, key=lambda r: (r.clip_id, r.k)):
        n, total = seen.get(r.clip_id, (0, 0))
        out[(r.clip_id, r.k)] = (n, total)
        seen[r.clip_id] = (n + 1, total + r.x)
    return out


@pytest.mark.parametrize("max_group_rows", [0, 500, 10_000])
def test_prefix_sums(hot, max_group_rows):
    got = ordering.prefix_sums(
        hot, ["clip_id"], ["k"], {"n": F.lit(1).cast("bigint"), "before": F.col("x")}, max_group_rows
    ).collect()
    assert {(r.clip_id, r.k): (r.n, r.before) for r in got} == expected(hot.collect())
    assert got[0].asDict().keys() == {"clip_id", "k", "x", "n", "before"}


def test_segments_split_the_hot_group(spark, hot):
    """The hot group spreads over range partitions instead of filling one."""
    ranged = hot.repartitionByRange(8, "clip_id", "k").withColumn("p", F.spark_partition_id())
    assert ranged.where("clip_id = 'hot'").select("p").distinct().count() > 2


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_global_index(spark, hot, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = ordering.global_index(hot, ["k"]).orderBy("idx").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r.idx for r in got] == list(range(3000))
    assert [r.k for r in got] == sorted(r.k for r in got)


@pytest.mark.parametrize(
    "start, end, n",
    [(None, None, 3000), (10, 20, 10), (-5, 3, 3), (2990, 9999, 10), (0, -1, 0), (5, 5, 0)],
)
def test_range_slice_clamps(hot, start, end, n):
    assert ordering.range_slice(hot, ["k"], start, end).count() == n


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("store", [True, False])
def test_attach_salted_equals_broadcast(spark, hot, how, store):
    per_key = hot.where("clip_id != 'g1'").groupBy("clip_id").agg(F.count("x").alias("n"))
    args = (hot, per_key, "clip_id", F.col("k"), how, store)
    columns = sorted(["clip_id", "k", "x", "n"])
    plain = ordering.attach(*args).select(columns)
    salted = ordering.attach(*args, max_broadcast_rows=1).select(columns)
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))
    assert "_salt" in shown(salted) and "_salt" not in shown(plain)


def shown(df):
    """The plan as text."""
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_seeded_shuffle_repeats(spark):
    ids = spark.range(200).select(F.col("id").alias("video_id"))
    a = [r.video_id for r in ordering.seeded_shuffle(ids, "video_id").collect()]
    b = [r.video_id for r in ordering.seeded_shuffle(ids.repartition(5), "video_id").collect()]
    other = [r.video_id for r in ordering.seeded_shuffle(ids, "video_id", seed=1).collect()]
    assert a == b and sorted(a) == list(range(200)) and a != sorted(a) and a != other


def test_limit_run(spark):
    got = [r.id for r in ordering.limit_run(spark.range(500).repartition(4), ["id"], 20).collect()]
    assert got == list(range(70))
