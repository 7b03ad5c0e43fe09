import os

import pytest
from pyspark.sql import functions as F

from reelmeter.fixed_values import PROMPT_MARK, QUESTION_WEIGHTS, QUESTIONS
from reelmeter.functions import text, video
from reelmeter.sources import files, results


def one(spark, column, *cells):
    return spark.createDataFrame([cells], [f"c{i}" for i in range(len(cells))]).select(column.alias("x")).first().x


def test_names(spark):
    assert one(spark, text.clean_title(F.col("c0")), "a b/c:d.e") == "a_b_c_d_e"
    path = F.lit("/r/t/scene_003.x.mp4")
    assert one(spark, text.scene_id(path, text.clean_title(F.col("c0"))), "a b/c:d.e") == "scene_003_a_b_c_d_e"
    assert one(spark, text.url_video_id(F.col("c0")), "http://x?v=a?v=b") == "b"
    assert one(spark, text.url_video_id(F.col("c0")), "plain") == "plain"


@pytest.mark.parametrize(
    "label, want",
    [
        ("carrot", "vehicles"), ("hot dog", "animals"), ("pancake", "food"), ("scarf", "vehicles"),
        ("airplane", "vehicles"), ("teddy bear", "animals"), ("skateboard", "others"),
        ("potted plant", "others"), ("Person", "humans"), ("", "others"),
    ],
)
def test_bucket(spark, label, want):
    assert one(spark, text.bucket(F.col("c0")), label) == want


def test_strip_pad(spark):
    df = spark.createDataFrame([({"a": "blue<pad><pad>", "b": " blue ", "c": "\n x <pad>\t"},)], "m map<string,string>")
    assert df.select(text.strip_pad(F.col("m")).alias("m")).first().m == {"a": "blue", "b": " blue ", "c": "x"}


def test_fit_dims_and_info(spark):
    m = spark.createDataFrame(
        [("a", 25.0, 100, 1920, 1080), ("b", 0.0, 10, 100, 400), ("c", None, None, None, None)],
        "clip_id string, fps double, total_frames int, width int, height int",
    )
    got = [r.d for r in m.select(video.fit_dims(F.col("width"), F.col("height"), 256, 256).alias("d")).collect()]
    assert tuple(got[0]) == (256, 144) and tuple(got[1]) == (64, 256)
    info = {r.clip_id: r for r in video.video_info(m).collect()}
    assert info["a"].duration_seconds == 4.0 and info["a"].resolution == "1920x1080" and info["a"].error is None
    assert info["b"].duration_seconds == 0.0
    assert info["c"].error is not None


def touch(root, *names):
    for name in names:
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(b"x" * len(name))


def test_clip_manifest(spark, tmp_path):
    touch(tmp_path, "b.mp4", "a.mp4", "c.txt", "sub/d.mp4")
    clips = files.clip_manifest(spark, str(tmp_path))
    rows = clips.collect()
    assert [r.video_id for r in rows] == [f"{tmp_path}/a.mp4", f"{tmp_path}/b.mp4"]
    assert rows[0].length == 5 and "content" not in clips.columns


def test_scene_manifest_takes_colliding_titles_once(spark, tmp_path):
    touch(tmp_path, "A_B/scene_001.mp4", "A_B/scene_002.x.mp4", "C/scene_001.mp4", "D/scene_001.mp4")
    titles = spark.createDataFrame([("A.B",), ("A B",), ("C",), ("none",)], "yt_clip_title string")
    got = files.scene_manifest(titles, files.scene_files(spark, str(tmp_path))).orderBy("video_id").collect()
    assert [(r.video_id, r.title) for r in got] == [
        ("scene_001_A_B", "A B"), ("scene_001_C", "C"), ("scene_002_A_B", "A B"),
    ]
    assert [tuple(r) for r in files.title_collisions(titles).collect()] == [("A_B", 2)]


def test_frame_dirs(spark, tmp_path):
    touch(tmp_path, "x/2.JPG", "x/1.png", "x/notes.txt", "y/1.webp", "y/.jpg")
    got = files.frame_dir_manifest(spark, str(tmp_path)).orderBy("path").collect()
    assert [(r.path[len(str(tmp_path)):], r.frame_no) for r in got] == [("/x/1.png", 0), ("/x/2.JPG", 1), ("/y/1.webp", 0)]
    touch(tmp_path, "z/empty.txt")
    with pytest.raises(ValueError):
        files.frame_dir_manifest(spark, str(tmp_path / "z"))


def test_questions(spark, tmp_path):
    q, w = tmp_path / "q.txt", tmp_path / "w.json"
    q.write_text("\n".join(QUESTIONS))
    w.write_text(str(list(QUESTION_WEIGHTS)))
    read = files.questions_from_files(spark, str(q), str(w)).orderBy("q_idx")
    assert [tuple(r) for r in read.collect()] == [tuple(r) for r in files.default_questions(spark).collect()]
    kept = files.drop_prompt_questions(read).collect()
    assert len(kept) == 26 and kept[0].q_idx == 3 and not any(PROMPT_MARK in r.question for r in kept)


def test_catalog_order_and_first_links(spark, tmp_path):
    rows = [("t1", "z"), ("t2", "y"), ("t1", "a"), ("t2", "b")]
    path = str(tmp_path / "catalog")
    spark.createDataFrame(rows, "yt_clip_title string, yt_clip_link string").coalesce(1).write.parquet(path)
    got = results.first_links(files.catalog(spark, path)).collect()
    assert {r.yt_clip_title: r.yt_clip_link for r in got} == {"t1": "z", "t2": "y"}
    ordered = spark.createDataFrame([(2, "t", "x"), (1, "t", "y")], "n int, yt_clip_title string, yt_clip_link string")
    ordered.write.parquet(f"{path}-2")
    assert results.first_links(files.catalog(spark, f"{path}-2", "n")).first().yt_clip_link == "y"


def test_results(spark, tmp_path):
    root = str(tmp_path)
    assert results.read_results(spark, root, "m") is None
    a = spark.createDataFrame([(1.0, "a", {1: 2.0}), (2.0, "b", {})], "score double, video_id string, m map<int,double>")
    results.write_results(a, root, "m", "1")
    results.write_results(a, root, "m", "1")  # a repeated run replaces itself
    assert results.read_results(spark, root, "m").count() == 2
    assert results.read_results(spark, root, "m").columns[0] == "video_id"
    assert results.read_other_runs(spark, root, "m", "1").count() == 0
    clips = spark.createDataFrame([("a",), ("c",)], "video_id string")
    assert [r.video_id for r in results.skip_processed(clips, a).collect()] == ["c"]
    assert results.skip_processed(clips, None).count() == 2
    results.write_csv(a, f"{root}/csv")
    back = spark.read.option("header", True).csv(f"{root}/csv")
    assert back.columns == ["video_id", "score", "m"]
    assert {r.video_id: r.m for r in back.collect()} == {"a": '{"1":2.0}', "b": "{}"}


def test_merge_keeps_stored_rows(spark):
    schema = "video_id string, score double, m map<int,double>"
    old = spark.createDataFrame([("a", 1.0, {0: 1.0}), ("b", 2.0, {}), ("b", 2.5, {})], schema)
    new = spark.createDataFrame([("b", 9.0, {}), ("c", 3.0, {})], schema)
    got = results.merge_results(old, new).orderBy("video_id").collect()
    assert [tuple(r) for r in got] == [("a", 1.0, {0: 1.0}), ("b", 2.0, {}), ("c", 3.0, {})]


def test_merge_keeps_all_parts_of_a_clip(spark):
    schema = "video_id string, part_no int, score double, m map<int,double>"
    old = spark.createDataFrame(
        [("a", 0, 1.0, {0: 1.0}), ("a", 1, 1.0, {1: 1.0}), (None, 0, 4.0, {}), (None, 1, 4.0, {})], schema
    )
    new = spark.createDataFrame(
        [("a", 0, 9.0, {0: 9.0}), ("a", 1, 9.0, {1: 9.0}), ("a", 2, 9.0, {2: 9.0}), (None, 2, 9.0, {}),
         ("c", 0, 3.0, {0: 3.0}), ("c", 1, 3.0, {1: 3.0})], schema,
    )
    got = results.merge_results(old, new).orderBy("video_id", "part_no").collect()
    assert [tuple(r) for r in got] == [
        (None, 0, 4.0, {}), (None, 1, 4.0, {}), ("a", 0, 1.0, {0: 1.0}), ("a", 1, 1.0, {1: 1.0}),
        ("c", 0, 3.0, {0: 3.0}), ("c", 1, 3.0, {1: 3.0}),
    ]
