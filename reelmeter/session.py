"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "reelmeter", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect (UTC, ANSI, AQE).

    ``master`` is left to spark-submit unless given. On a cluster, size
    ``spark.sql.shuffle.partitions`` so that one partition of the largest
    shuffle stays near 128-256 MB; AQE coalesces what turns out small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    if master and master.startswith("local"):
        settings.setdefault("spark.sql.shuffle.partitions", str(os.cpu_count() or 4))
        settings.setdefault("spark.ui.enabled", "false")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.basename(os.path.dirname(os.path.abspath(__file__)))
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix=f"{name}-ship-"), name), "zip", root, name
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder of the session.

    The folder is the one named in ``spark.checkpoint.dir``. Only a local
    session without that setting (tests) gets a temporary folder; a cluster
    without it is an error, since executors would not share the folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="reelmeter-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/reelmeter/{name}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    system, target = _hadoop_path(spark, path)
    return system.exists(target)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders or files that nothing reads any more."""
    for path in paths:
        system, target = _hadoop_path(spark, path)
        system.delete(target, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where two branches must see the very same rows in the very same
    layout (range partitions are drawn from a sample, so evaluating the plan
    twice could place rows differently), or where recomputing is expensive.
    A lost executor costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_most(df: DataFrame, rows: int, size: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows and ``size`` bytes as JSON text."""
    if df.count() > rows:
        return False
    text = F.octet_length(F.to_json(F.struct(*df.columns)))
    return (df.agg(F.sum(text)).first()[0] or 0) <= size


def few_rows(df: DataFrame, limit: int = 1000) -> list[Row]:
    """The rows of a table that is small by its nature; more than ``limit`` are refused."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows")
    return rows


def task_count(spark: SparkSession) -> int:
    """Partitions of an explicit repartitioning: those of the session's shuffles."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tasks_for(df: DataFrame, rows: int) -> int:
    """Partitions of about ``rows`` rows of ``df`` each, at least one for every core.

    Shuffles that are sized by their compressed bytes put more rows into a task the better these compress; where tasks
    hold sorted or hashed rows, their number is what bounds a task. ``df`` is counted, so it should be cheap to scan.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, 1 + df.count() // rows)
