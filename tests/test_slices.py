"""Slices whose ends are found by counting."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reelmeter.operators import ordering
from reelmeter.operators.ordering import key_at, range_slice


@pytest.fixture(autouse=True)
def small_rounds(monkeypatch):
    monkeypatch.setattr(ordering, "SPLITS", 8)
    monkeypatch.setattr(ordering, "LEAF", 5)


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(4)


def test_every_position(spark):
    rng = random.Random(2)
    values = rng.sample(range(-500, 500), 60)
    frame = table(spark, [(v,) for v in values], "k long")
    want = sorted(values)
    for p in (0, 1, 7, 31, 58, 59):
        assert key_at(frame, ["k"], p)["k"] == want[p]
    assert key_at(frame, ["k"], 60) is None and key_at(frame.where("false"), ["k"], 0) is None


@pytest.mark.parametrize("start,end", [(None, None), (0, 10), (5, 6), (17, 40), (50, None), (59, 60), (60, 70), (10, 10), (20, 5), (-3, 4), (3, 10**9)])
def test_slices(spark, start, end):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), i, f"v{i}") for i in range(60)]
    frame = table(spark, rows, "g string, k long, v string")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    low, high = max(0, start or 0), 60 if end is None else max(0, end)
    want = {(i, r[2]) for i, r in enumerate(order) if low <= i < high}
    got = range_slice(frame, ["g", "k"], start, end)
    assert {(r.idx, r.v) for r in got.collect()} == want and got.count() == len(want)


def test_kinds_of_keys(spark):
    """Dates, times, decimals, bytes and structs, with nulls."""
    day = dt.date(2024, 1, 1)
    rows = [(day + dt.timedelta(i), dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(i), bytes([i]), ("f", i)) for i in range(40)]
    rows.append((None, None, None, None, None))
    frame = table(spark, rows, "d date, t timestamp_ntz, x double, b binary, s struct<file:string,row:int>")
    for c in "dtxbs":
        got = [r[c] for r in range_slice(frame, [c], 11, 14).orderBy("idx").collect()]
        assert [tuple(v) if c == "s" else bytes(v) if c == "b" else v for v in got] == [r["dtxbs".index(c)] for r in rows[10:13]]
        assert range_slice(frame, [c], 0, 1).first()[c] is None


def test_equal_keys_are_refused(spark):
    frame = table(spark, [(1,)] * 30 + [(2,)], "k long")
    with pytest.raises(ValueError, match="not unique"):
        key_at(frame, ["k"], 12)


def test_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v")).write.parquet(path)
    frame = spark.read.parquet(path)
    keys = ordering._Keys(frame, ["k"])
    inside = frame.where(keys.between(key_at(frame, ["k"], 100), key_at(frame, ["k"], 120)))
    plan = inside._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(k,100)" in plan and "LessThanOrEqual(k,120)" in plan
    assert sorted(r.k for r in inside.collect()) == list(range(100, 120))


def test_only_the_slice_is_written(spark, tmp_path, monkeypatch):
    written = []
    real = ordering.stored
    monkeypatch.setattr(ordering, "stored", lambda df, name: written.append(df.count()) or real(df, name))
    assert range_slice(spark.range(1000).toDF("k"), ["k"], 400, 450).count() == 50
    assert written == [50]
