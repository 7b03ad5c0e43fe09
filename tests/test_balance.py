import random

import pytest
from pyspark.sql import functions as F

from reelmeter.operators.balance import _water_level, balance, deal_by_cost, score_by_cost


def dealt(spark, costs, tasks):
    frame = spark.createDataFrame([(f"c{i:05d}", c, "x") for i, c in enumerate(costs)], "video_id string, length long, path string")
    found = deal_by_cost(frame, "length", tasks)
    assert found.columns == ["video_id", "length", "path", "task"]
    rows = found.collect()
    assert sorted((r.video_id, r.length) for r in rows) == sorted((f"c{i:05d}", c) for i, c in enumerate(costs))
    loads = [0] * tasks
    for r in rows:
        loads[r.task] += r.length or 0
    return loads


@pytest.mark.parametrize("seed", range(3))
def test_tasks_are_even(spark, seed):
    rng = random.Random(seed)
    costs = [int(rng.paretovariate(1.2) * 100) for _ in range(800)]
    loads = dealt(spark, costs, 8)
    mean = sum(costs) / 8
    assert max(loads) <= max(1.5 * mean, max(costs))


def test_one_clip_of_a_third(spark):
    costs = [10] * 600 + [3000]
    loads = dealt(spark, costs, 6)
    assert max(loads) == 3000 and sorted(loads)[:5] == [1200] * 5  # alone in its task, the others share the rest


def test_large_clips_go_one_by_one(spark):
    assert sorted(dealt(spark, [90, 60, 50, 40, 40, 20], 3)) == [90, 100, 110]
    assert sorted(dealt(spark, [50, 50, 50, 50], 2)) == [100, 100]


def test_odd_costs(spark):
    assert sum(dealt(spark, [None, 0, 5, None], 3)) == 5
    assert dealt(spark, [0, 0], 2) == [0, 0]
    empty = spark.createDataFrame([], "video_id string, length long, path string")
    assert deal_by_cost(empty, "length", 4).count() == 0
    twice = spark.createDataFrame([("a", 100, "p")] * 3 + [("b", -5, "p"), (None, 100, None)], "video_id string, length long, path string")
    found = deal_by_cost(twice, "length", 2)
    assert found.count() == 5
    assert balance(found, "length").first().asDict() == {"rows": 5, "tasks": 2, "cost": 400.0, "largest_task": 200.0, "largest_clip": 100.0}


def test_water_level():
    assert _water_level([0, 0, 0], 9) == 3 and _water_level([10, 0, 0], 4) == 2 and _water_level([1, 2, 3], 6) == 4
    assert _water_level([5], 0) == 5


def test_scoring_in_dealt_tasks(spark):
    clips = spark.range(100).select(F.format_string("c%d", "id").alias("clip_id"), F.when(F.col("id") == 7, 1000).otherwise(10).alias("length"))

    def infer(_, batch):
        from pyspark import TaskContext

        return [{"task": TaskContext.get().partitionId(), "n": len(batch)} for _ in range(len(batch))]

    scored = score_by_cost(clips, "length", 5, lambda: None, infer, "struct<task:int,n:int>", ["clip_id"], 16)
    rows = scored.select("clip_id", "result.*").collect()
    alone = next(r.task for r in rows if r.clip_id == "c7")
    assert [r.clip_id for r in rows if r.task == alone] == ["c7"]
    assert len({r.task for r in rows}) == 5 and max(r.n for r in rows) == 16
