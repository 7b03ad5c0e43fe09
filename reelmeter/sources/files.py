"""Listings of clips, scenes and frame directories, and the small side tables.

Listings use Spark's ``binaryFile`` source without its ``content`` column, so
only names and sizes are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmeter.fixed_values import IMAGE_SUFFIXES, PROMPT_MARK, QUESTION_WEIGHTS, QUESTIONS, SHOT_PROMPTS
from reelmeter.functions.text import base_name, clean_title, scene_id
from reelmeter.operators.ordering import attach, dense_index
from reelmeter.schemas import QUESTION_TABLE


def _tree(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select(_plain_path(), "length", F.col("modificationTime").alias("modified"))


def _plain_path() -> Column:
    return F.regexp_replace("path", r"^file:/+", "/").alias("path")


def clip_columns() -> list[Column]:
    """Clip rows of a file listing; the path is the id."""
    return [_plain_path().alias("video_id"), _plain_path(), F.col("length"), F.col("modificationTime").alias("modified")]


def clip_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The ``*.mp4`` files directly under ``root``, by path; the path is the id."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.mp4")
    return reader.load(root).select(*clip_columns()).orderBy("path")


def catalog(spark: SparkSession, path: str, order: str | None = None) -> DataFrame:
    """Catalog of titles and links with an explicit ``ord`` column.

    Without a column to order by, file position and row position in the file
    give the order the table was written in.
    """
    table = spark.read.parquet(path)
    if order:
        return table.withColumn("ord", F.col(order).cast("bigint"))
    return table.select(
        "*",
        F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("ord"),
    )


def scene_files(spark: SparkSession, root: str) -> DataFrame:
    """All ``<root>/<clean_title>/<scene>.mp4`` files."""
    return (
        _tree(spark, root, "*.mp4")
        .withColumn("clean_title", F.element_at(F.split("path", "/"), -2))
        .select("clean_title", "path")
    )


def scene_manifest(titles: DataFrame, files: DataFrame, title: str = "yt_clip_title") -> DataFrame:
    """Scenes of the listed titles, one row per file.

    Titles that clean to the same text name the same directory: its files are
    taken once, under the first of those titles (see ``title_collisions``).
    """
    named = titles.withColumn("clean_title", clean_title(F.col(title)))
    once = named.groupBy("clean_title").agg(F.min(title).alias("title"))
    return attach(files, once, "clean_title", F.xxhash64("path")).select(
        scene_id(F.col("path"), F.col("clean_title")).alias("video_id"),
        "title",
        "clean_title",
        F.split(base_name(F.col("path")), r"\.")[0].alias("scene"),
        "path",
    )


def title_collisions(titles: DataFrame, title: str = "yt_clip_title") -> DataFrame:
    """Cleaned titles shared by several titles, with how many there are."""
    return (
        titles.select(clean_title(F.col(title)).alias("clean_title"), title)
        .distinct()
        .groupBy("clean_title")
        .agg(F.count(F.lit(1)).alias("n_titles"))
        .where("n_titles > 1")
    )


def image_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """Image files of each directory with their position in path order."""
    suffix = F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)$", 1))
    images = paths.where(suffix.isin(*IMAGE_SUFFIXES)).withColumn(
        "clip_id", F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    )
    return dense_index(images, ["clip_id"], [path], "frame_no")


def frame_dir_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Frames of the image directories under ``root``; the directory is the clip.

    A directory tree without any image is an error, as there is nothing to score.
    """
    listing = _tree(spark, root)
    frames = image_files(listing).select("clip_id", "frame_no", "path")
    if frames.isEmpty():
        raise ValueError(f"No image frames found in {root}")
    return frames


def questions_from_files(spark: SparkSession, questions_path: str, weights_path: str) -> DataFrame:
    """Questions (one a line) with the weights of a JSON array, joined by position."""
    lines = spark.read.text(questions_path, wholetext=True).select(
        F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")).alias("q_idx", "question")
    )
    weights = spark.read.text(weights_path, wholetext=True).select(
        F.posexplode(F.from_json("value", "array<double>")).alias("q_idx", "weight")
    )
    return lines.join(weights, "q_idx")


def default_questions(spark: SparkSession) -> DataFrame:
    """The fixed question table (29 rows)."""
    rows = [(i, q, w) for i, (q, w) in enumerate(zip(QUESTIONS, QUESTION_WEIGHTS))]
    return spark.createDataFrame(rows, QUESTION_TABLE)


def drop_prompt_questions(questions: DataFrame) -> DataFrame:
    """Questions that can be asked without a prompt; numbering is kept."""
    return questions.where(~F.contains("question", F.lit(PROMPT_MARK)))


def shot_prompts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(SHOT_PROMPTS)), "p_idx int, prompt string")
