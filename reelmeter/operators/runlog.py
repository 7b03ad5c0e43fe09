"""Reports on a run log: one row per item with its metric, times and error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmeter.functions.arithmetic import whole
from reelmeter.operators.ordering import MAX_GROUP_ROWS, prefix_sums
from reelmeter.session import stored


def run_summary(log: DataFrame, workers: int = 1) -> DataFrame:
    """Items, time, throughput and parallel efficiency of each metric."""
    ok = F.col("error").isNull()
    sums = log.groupBy("metric").agg(
        F.count_if(ok).alias("processed"),
        ((F.max(F.unix_micros("finished")) - F.min(F.unix_micros("started"))) / F.lit(1e6)).alias("total_s"),
        (F.sum(F.unix_micros("finished") - F.unix_micros("started")) / F.count(F.lit(1)) / F.lit(1e6)).alias("busy_s"),
    )
    n = F.col("processed").cast("double")
    speedup = F.when(F.col("busy_s") > 0, F.try_divide(n, F.try_divide("total_s", "busy_s"))).otherwise(1.0)
    return sums.select(
        "metric",
        "processed",
        "total_s",
        F.try_divide(n, F.col("total_s")).alias("items_per_s"),
        F.try_divide(F.col("total_s"), n).alias("s_per_item"),
        speedup.alias("speedup"),
        (speedup / F.lit(float(workers)) * 100).alias("efficiency_pct"),
    )


def checkpoint_windows(
    log: DataFrame,
    every: int = 50,
    order: Sequence[str] = ("finished", "seq"),
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Items and throughput between checkpoints, one checkpoint per ``every`` successes.

    An item belongs to the window of the successes before it, in order of
    finishing; failures count as handled items. ``order`` must be unique. Time runs
    from the previous window's last item, from the first start at the beginning.
    """
    success = F.col("error").isNull().cast("bigint")
    counted = prefix_sums(log, ["metric"], order, {"before": success}, max_group_rows)
    windows = (
        counted.groupBy("metric", whole("before", every).alias("window_no"))
        .agg(
            F.count(F.lit(1)).alias("items"),
            F.sum(success).alias("successes"),
            F.max(F.unix_micros("finished")).alias("end"),
            F.min(F.unix_micros("started")).alias("first_start"),
        )
    )
    # Written once, as it is read twice. The previous window is an equality on
    # its number, not a window function: a metric has items / every windows.
    windows = stored(windows, "checkpoint-windows")
    previous = windows.select(
        "metric", (F.col("window_no") + 1).alias("window_no"), F.col("end").alias("previous_end")
    )
    seconds = (F.col("end") - F.coalesce("previous_end", "first_start")) / F.lit(1e6)
    return (
        windows.join(previous, ["metric", "window_no"], "left")
        .withColumn("seconds", seconds)
        .select(
            "metric",
            "window_no",
            "items",
            "successes",
            "seconds",
            F.try_divide(F.col("seconds"), F.col("items").cast("double")).alias("s_per_item"),
            F.try_divide(F.col("items").cast("double"), F.col("seconds")).alias("items_per_s"),
        )
    )


def error_summary(
    log: DataFrame, shown: int = 5, width: int = 100, order: Sequence[str] = ("seq",)
) -> DataFrame:
    """The first few errors, cut to ``width`` characters, with the number of all."""
    failed = log.where(F.col("error").isNotNull())
    total = failed.agg(F.count(F.lit(1)).alias("n_errors"))
    first = failed.orderBy(*order).limit(shown)
    return first.select(
        *dict.fromkeys([*order, "video_id"]), F.left("error", F.lit(width)).alias("message"), total.scalar().alias("n_errors")
    )


def metric_timing(log: DataFrame) -> DataFrame:
    """Seconds per metric and their mean over metrics."""
    per_metric = log.groupBy("metric").agg(
        ((F.max(F.unix_micros("finished")) - F.min(F.unix_micros("started"))) / F.lit(1e6)).alias("seconds")
    )
    every_metric = Window.partitionBy(F.lit(0))  # a handful of rows
    return per_metric.withColumn("mean_seconds", F.avg("seconds").over(every_metric))
