"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmeter.session import scratch_path

#: The characters that part words where a contract says ``[^\x20\x09-\x0D]+``.
SPACE = r"\x20\x09-\x0D"


def kept_on_disk(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once to the shared folder and read back, with the path for ``discard``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables that ``kept_on_disk`` wrote, once nothing reads them any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def total_bytes(df: DataFrame, column: str) -> int:
    return df.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores behind it until no column of ``taken`` is called so (case does not count)."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Fewer rows to an Arrow batch while jobs are run here, for rows that are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
