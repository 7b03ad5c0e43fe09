"""The operators as queries on the test tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmeter.llm import (
    centroids,
    chat,
    decontamination,
    html_text,
    jaccard_join,
    line_dedup,
    packing,
    quality,
    substrings,
    token_files,
    toxicity,
    url_rules,
    whitening,
)
from reelmeter.llm.sql import ORACLES  # noqa: F401
from reelmeter.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(_table(spark, sf_dir, "documents"), size=3, percent=90)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path)
    return token_files.read_documents(spark, path)


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages").select("page_id", "html"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    path = scratch_path(spark, "conversations")
    chat.format_conversations(rows.unionByName(extra)).write.option("compression", "zstd").parquet(path)
    return chat.read_back(spark, path)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_removed",
        F.char_length("text").cast("long").alias("n_chars_left"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_repeats(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


#: The rules of ``op11_url_rules``.
URL_RULES = (
    url_rules.Rule("org", "/", "allow"),
    url_rules.Rule("example.org", "/es/", "block"),
    url_rules.Rule("example.org", "/en/1", "block"),
    url_rules.Rule("com", "/fr/", "allow"),
    url_rules.Rule("com", "/de/", "block"),
)


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filter_urls(_table(spark, sf_dir, "pages"), url_rules.rule_table(spark, list(URL_RULES)))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_jaccard,
        op3_decontamination,
        op4_token_files,
        op5_html,
        op6_chat,
        op7_line_dedup,
        op8_packing,
        op9_substrings,
        op10_toxicity,
        op11_url_rules,
        op12_centroids,
        op13_whitening,
    )
}
