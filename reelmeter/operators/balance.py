"""Clips dealt to tasks by what they cost, from metadata alone."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmeter.operators.ordering import prefix_sums
from reelmeter.operators.scoring import score_batches
from reelmeter.session import stored


def _water_level(loads: list[float], amount: float) -> float:
    """The level up to which ``amount`` fills tasks that hold ``loads``."""
    filled = sorted(loads)
    below = 0.0
    for i, load in enumerate(filled, 1):
        below += load
        level = (amount + below) / i
        if i == len(filled) or level <= filled[i]:
            return level
    return 0.0


def deal_by_cost(clips: DataFrame, cost: str, tasks: int, key: str = "video_id") -> DataFrame:
    """``clips`` with ``task`` (0 to ``tasks`` - 1), so that all tasks cost about the same.

    Clips of more than half the mean cost of a task (at most twice as many as tasks) go one by one,
    the largest first, to the task that has least so far. The others, in order of a hash of their key,
    fill what is left of the tasks: a running sum of costs says which. So a task has at most half a mean more
    than the others, unless one clip alone is more. ``key`` should be unique; rows with equal keys
    may be dealt apart. Null and negative costs count as 0. Columns other than ``key`` and ``cost`` ride along,
    so keep them light: ids and paths, never pixels.
    """
    value = F.greatest(F.coalesce(F.col(cost), F.lit(0)), F.lit(0)).cast("double")
    rows = stored(clips.withColumns({"_cost": value, "_hash": F.xxhash64(key)}), "costs")
    total = rows.agg(F.sum("_cost")).first()[0] or 0.0
    half = total / tasks / 2
    is_large = F.col("_cost") > half
    # fewer than 2 * tasks rows cost more than half a mean
    large = rows.where(is_large).groupBy("_hash", "_cost").agg(F.count(F.lit(1)).alias("n")).collect()
    loads = [(0.0, t) for t in range(tasks)]
    heapq.heapify(loads)
    placed = []
    for row in sorted(large, key=lambda r: (-r["_cost"], r["_hash"])):
        for copy in range(row["n"]):
            load, t = heapq.heappop(loads)
            heapq.heappush(loads, (load + row["_cost"], t))
            placed.append((row["_hash"], row["_cost"], copy, t))
    load_of = dict((t, load) for load, t in loads)
    held = [load_of[t] for t in range(tasks)]
    level = _water_level(held, total - sum(held))
    ends = np.cumsum([max(0.0, level - x) for x in held])

    @F.pandas_udf(T.IntegerType())
    def task_of(before: pd.Series) -> pd.Series:
        return pd.Series(np.minimum(np.searchsorted(ends, before.to_numpy(), "right"), tasks - 1).astype("int32"))

    small = rows.where(~is_large)
    # the range partitioned way: no task sorts all clips
    summed = prefix_sums(small.withColumn("_one", F.lit(0)), ["_one"], ["_hash", key], {"_before": F.col("_cost")}, max_group_rows=0)
    dealt = summed.withColumn("task", task_of(F.col("_before") + F.col("_cost") / 2)).drop("_one", "_before")
    table = clips.sparkSession.createDataFrame(placed, "_hash long, _cost double, _copy int, task int")
    numbered = rows.where(is_large).withColumn("_copy", F.lit(0))
    if any(copy for _, _, copy, _ in placed):
        # equal keys of equal cost: there are as few of them as of large clips
        w = Window.partitionBy("_hash", "_cost").orderBy(key)
        numbered = numbered.withColumn("_copy", (F.row_number().over(w) - 1).cast("int"))
    joined = numbered.join(F.broadcast(table), ["_hash", "_cost", "_copy"]).drop("_copy")
    return dealt.unionByName(joined).drop("_hash", "_cost")


def score_by_cost(
    items: DataFrame,
    cost: str,
    tasks: int,
    load_fn: Callable[[], Any],
    infer_fn: Callable[[Any, pd.DataFrame], Iterable],
    result_type: T.DataType | str,
    keys: Sequence[str],
    batch_size: int = 32,
) -> DataFrame:
    """``score_batches`` in ``tasks`` tasks of about equal cost; each is one partition, whatever the shuffle's hash."""
    dealt = deal_by_cost(items, cost, tasks, keys[0]).repartitionById(tasks, "task")
    return score_batches(dealt, load_fn, infer_fn, result_type, keys, batch_size)


def balance(dealt: DataFrame, cost: str) -> DataFrame:
    """One row: rows, tasks that have any, total and largest cost of a task, largest cost of a clip."""
    value = F.greatest(F.coalesce(F.col(cost), F.lit(0)), F.lit(0)).cast("double")
    per = dealt.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("c"), F.max(value).alias("one"))
    return per.agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("tasks"), F.sum("c").alias("cost"),
        F.max("c").alias("largest_task"), F.max("one").alias("largest_clip"),
    )
