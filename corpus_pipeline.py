"""From documents to packed training sequences: five stages, each stored before the next begins.

Toxic documents go, lines that many sites share go but once, one document of
each group of similar ones stays, documents with benchmark passages go, and what
is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelmeter.llm.decontamination import drop_contaminated
from reelmeter.llm.jaccard_join import drop_similar
from reelmeter.llm.line_dedup import dedup_lines
from reelmeter.llm.packing import pack_documents
from reelmeter.llm.toxicity import drop_toxic
from reelmeter.session import scratch_path, ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines(docs, count=None)


def similar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words and a similarity of 0.8."""
    ship_package(spark)
    return drop_similar(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxic_documents),
    ("line_dedup", boilerplate_lines),
    ("jaccard_join", similar_documents),
    ("decontamination", benchmark_passages),
    ("packing", packed_sequences),
]

#: Token ids and scores are beyond SQL; ``tests/llm`` holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result stored in the shared folder and read by the next.

    Null and empty texts pass the filters and are packed as an end id alone; texts of any length are judged whole. Rows
    with a null doc_id stay rows of their own; of repeated rows one stays. Columns may have any names beside those of
    ``documents``. Empty tables give an empty result; without labels the known insults alone decide.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
