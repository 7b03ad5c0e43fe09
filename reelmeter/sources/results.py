"""Result sinks: Parquet partitioned by metric, flattened CSV, resume and merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def id_first(results: DataFrame, key: str = "video_id") -> DataFrame:
    return results.select(key, *[c for c in results.columns if c != key])


def run_path(root: str, metric: str, run_id: str) -> str:
    """Folder of one run; the prefix keeps run ids text when they are read back."""
    return f"{root}/metric={metric}/run_id=run-{run_id}"


def write_results(results: DataFrame, root: str, metric: str, run_id: str) -> None:
    """Add one run's results under ``root/metric=.../run_id=...``.

    A repeated run replaces its own folder only; other results stay untouched.
    """
    id_first(results).write.mode("overwrite").parquet(run_path(root, metric, run_id))


def write_scored(scored: DataFrame, root: str, metric: str, run_id: str) -> DataFrame:
    """Store scored items and failures in one pass, split into ``status`` folders.

    One write means the model runs once although results and errors are
    separate tables afterwards (``read_scored``). Returns this run's rows.
    """
    status = F.when(F.col("error").isNull(), "ok").otherwise("failed")
    rows = scored.withColumn("status", status)
    path = run_path(root, metric, run_id)
    rows.write.mode("overwrite").partitionBy("status").parquet(path)
    # the schema is given since a run with nothing left to score writes no file
    return scored.sparkSession.read.schema(rows.schema).parquet(path).drop("status")


def read_scored(spark: SparkSession, root: str, metric: str, ok: bool = True) -> DataFrame | None:
    """Scored rows (or failures) of all runs of a metric; None before the first run."""
    stored = read_results(spark, root, metric)
    if stored is None:
        return None
    return stored.where(F.col("status") == ("ok" if ok else "failed")).drop("status")


def write_csv(results: DataFrame, path: str) -> None:
    """CSV with a header; nested columns become JSON text."""
    nested = (T.MapType, T.ArrayType, T.StructType)
    flat = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in id_first(results).schema
    ]
    results.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def read_results(
    spark: SparkSession, root: str, metric: str, skip_damaged: bool = False
) -> DataFrame | None:
    """All stored rows of a metric; None when there are none.

    ``skip_damaged`` leaves out files that cannot be read instead of failing.
    """
    path = f"{root}/metric={metric}"
    reader = spark.read.option("basePath", path).option("ignoreCorruptFiles", skip_damaged)
    try:
        return reader.parquet(path)
    except AnalysisException:
        return None


def read_other_runs(spark: SparkSession, root: str, metric: str, run_id: str) -> DataFrame | None:
    """Stored rows of every run but this one, whose folder a repeated run replaces.

    This is what a resumed run skips: clips in damaged files are scored afresh.
    """
    stored = read_results(spark, root, metric, skip_damaged=True)
    return None if stored is None else stored.where(F.col("run_id") != f"run-{run_id}")


def processed_ids(results: DataFrame, key: str = "video_id") -> DataFrame:
    return results.select(key).distinct()


def skip_processed(clips: DataFrame, processed: DataFrame | None, key: str = "video_id") -> DataFrame:
    """Clips without a stored result; ids are all that is read of the results."""
    if processed is None:
        return clips
    return clips.join(processed_ids(processed, key), key, "left_anti")


def merge_results(old: DataFrame, new: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Union of both with one row per key; a stored row wins over a new one.

    The key is the clip, with the part where results are stored in parts: all
    parts of a clip stay. A stored clip wins as a whole, so parts of two ages
    never meet in one clip. Aggregation instead of a window, so copies of one
    id meet partially reduced. Equal ages are decided by the remaining
    columns, in order.
    """
    if keys is None:
        keys = ("video_id", "part_no") if "part_no" in old.columns else ("video_id",)
    if "part_no" in keys:
        new = _not_stored(new, old, [k for k in keys if k != "part_no"])
    columns = [c for c in old.columns if c not in keys]
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    ordered = [f.name for f in old.schema if f.name in columns and not _has_map(f.dataType)]
    kept = both.groupBy(*keys).agg(
        F.min_by(F.struct(*columns), F.struct("_age", *ordered)).alias("_row")
    )
    return kept.select(*keys, *[F.col("_row")[c].alias(c) for c in columns])


def _not_stored(new: DataFrame, old: DataFrame, clip: Sequence[str]) -> DataFrame:
    """Rows of clips that ``old`` has no row of; a null id is an id like any other."""
    ids = old.select(F.struct(*clip).alias("_stored")).distinct()
    return new.join(ids, F.struct(*clip) == F.col("_stored"), "left_anti")


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType)


def first_links(catalog: DataFrame, title: str = "yt_clip_title", link: str = "yt_clip_link", order: str = "ord") -> DataFrame:
    """Each title with the link of its first catalog row."""
    return catalog.groupBy(title).agg(F.min_by(link, order).alias(link), F.min(order).alias(order))
