import numpy as np
import pytest
from pyspark.sql import functions as F

from reelmeter.functions.frames import area_weights, bright_share, crop_boundary, to_gray
from reelmeter.operators import cropping, motion

H, W = 48, 64


def pattern(k, f, shift, dark=(0, 0), size=(H, W)):
    """Gray pattern moving ``shift`` pixels a frame, with dark rows on top and at the bottom."""
    r, c = np.mgrid[: size[0], : size[1]]
    g = ((7 * r + 13 * (c + shift * f) + 31 * k) % 256).astype(np.uint8)
    g[: dark[0]] = 0
    if dark[1]:
        g[-dark[1] :] = 0
    return g


def gray_table(spark, frames):
    """Rows from {(clip, n): array}."""
    rows = [(c, n, n, *g.shape, bytearray(g.tobytes())) for (c, n), g in frames.items()]
    return spark.createDataFrame(
        rows, "clip_id string, sample_no bigint, frame_no int, height int, width int, gray binary"
    )


def test_luma(spark):
    bgr = [(0, 0, 0), (255, 255, 255), (255, 0, 0), (0, 255, 0), (0, 0, 255)]
    flat = [v for px in bgr for v in px]
    df = spark.createDataFrame([(bytearray(flat), "BGR"), (bytearray(flat), "RGB")], "p binary, c string")
    got = [list(r.g) for r in df.select(to_gray(F.col("p"), F.col("c")).alias("g")).collect()]
    assert got == [[0, 255, 29, 150, 76], [0, 255, 76, 150, 29]]


def boundary(spark, g, position):
    df = gray_table(spark, {("a", 0): g})
    b = df.withColumn("bright", bright_share(F.col("gray"), F.col("height"), F.col("width")))
    return b.select(crop_boundary(F.col("bright"), F.col("height"), F.col("width"), position).alias("x")).first().x


@pytest.mark.parametrize(
    "rows, top_dark, bottom_dark, top, bottom",
    [(200, 0, 0, 1, 198), (200, 20, 30, 20, 169), (200, 200, 0, 20, 170), (8, 1, 1, 1, 6)],
)
def test_crop_boundary(spark, rows, top_dark, bottom_dark, top, bottom):
    g = np.full((rows, 10), 200, np.uint8)
    g[:top_dark] = 0
    if bottom_dark:
        g[-bottom_dark:] = 0
    assert boundary(spark, g, "top") == top
    assert boundary(spark, g, "bottom") == bottom


def test_black_region_modes(spark):
    g = {("a", 0): pattern(0, 0, 1, (6, 9)), ("b", 0): np.full((H, W), 128, np.uint8)}
    rows = cropping.row_brightness(gray_table(spark, g))
    got = {r.clip_id: (r.top_crop, r.bottom_crop) for r in cropping.frame_crop(rows, simple_percent=10.0).collect()}
    assert got == {"a": (4, 44), "b": (None, None)}
    got = {r.clip_id: (r.top_crop, r.bottom_crop) for r in cropping.frame_crop(rows, check_top=False, simple_percent=10.0).collect()}
    assert got["a"] == (None, 44)
    # a percentage that covers no row is never black
    got = cropping.frame_crop(rows, simple_percent=1.0).where("clip_id = 'a'").first()
    assert (got.top_crop, got.bottom_crop) == (None, None)


def test_median_truncates(spark):
    df = spark.createDataFrame(
        [("a", 3, None, 9), ("a", 4, None, 9), ("b", 1, 5, 9), ("b", 2, 5, 9), ("b", 9, 6, 9)],
        "clip_id string, top_crop int, bottom_crop int, height int",
    )
    got = {r.clip_id: (r.top_crop, r.bottom_crop) for r in cropping.median_crop(df).collect()}
    assert got == {"a": (3, None), "b": (2, 5)}


def colour_table(spark, frames):
    rows = [(c, n, *g.shape[:2], "RGB", bytearray(g.tobytes())) for (c, n), g in frames.items()]
    return spark.createDataFrame(rows, "clip_id string, frame_no int, height int, width int, channels string, pixels binary")


def test_crop_clips(spark):
    frames = {}
    for n in range(7):
        g = np.full((H, W), 180, np.uint8)
        g[-9:] = 0
        frames[("bars", n)] = np.stack([g] * 3, axis=2)
        frames[("plain", n)] = np.full((H, W, 3), 180, np.uint8)
    meta = spark.createDataFrame([("bars", 7, H), ("plain", 7, H), ("unread", 5, H)], "clip_id string, total_frames int, height int")
    table = colour_table(spark, frames)
    plan = {
        r.clip_id: r
        for r in cropping.clip_crop_plan(meta, table, check_top=False, simple_percent=10.0).collect()
    }
    assert (plan["bars"].start_y, plan["bars"].end_y, plan["bars"].status) == (0, 44, "cropped")
    assert plan["plain"].status == "skipped" and plan["unread"].status == "skipped"
    got = cropping.crop_clips(meta, table, bottom_percent=10.0, smart=False).collect()
    assert len(got) == 14
    for r in got:
        want = frames[(r.clip_id, r.frame_no)][: 44 if r.clip_id == "bars" else H]
        assert r.height == len(want) and bytes(r.pixels) == want.tobytes()
    smart = cropping.crop_clips(meta, table, bottom_percent=10.0)
    assert {(r.clip_id, r.height) for r in smart.collect()} == {("bars", H - 10), ("plain", H - 1)}


def test_invalid_crop_keeps_frames(spark):
    meta = spark.createDataFrame([("a", 1, 10)], "clip_id string, total_frames int, height int")
    crops = spark.createDataFrame([("a", 8, 3, 10)], "clip_id string, top_crop int, bottom_crop int, height int")
    plan = cropping.crop_status(cropping.median_crop(crops))
    assert plan.first().status == "invalid"
    frame = colour_table(spark, {("a", 0): np.full((10, 4, 3), 9, np.uint8)})
    assert len(cropping.apply_crop(frame, plan).first().pixels) == 120
    assert meta.count() == 1


@pytest.mark.parametrize("segment", [1, 2, 5, 256])
def test_pairs_do_not_depend_on_segments(spark, segment):
    rows = [(c, n, n * 10 + c) for c in range(3) for n in range(11 * (c == 0) + c)]
    df = spark.createDataFrame(rows, "clip_id int, sample_no bigint, x int").repartition(4)
    got = motion.frame_pairs(df, payload=("x",), segment=segment).collect()
    want = {(c, n, n * 10 + c, (n + 1) * 10 + c) for c, count in ((0, 11), (1, 1), (2, 2)) for n in range(count - 1)}
    assert {(r.clip_id, r.pair_no, r.prev_x, r.x) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("segment", [1, 2, 3, 4, 256])
def test_pairs_bridge_missing_frames(spark, segment):
    present = {"a": [0, 1, 2, 4, 5, 6, 9, 20, 21], "b": [7], "c": [3, 8], None: [0, 5]}
    rows = [(c, n, n * 10) for c, numbers in present.items() for n in numbers]
    df = spark.createDataFrame(rows, "clip_id string, sample_no bigint, x int").repartition(4)
    got = motion.frame_pairs(df, payload=("x",), segment=segment).collect()
    want = {(c, p, p * 10, n * 10) for c, numbers in present.items() for p, n in zip(numbers, numbers[1:])}
    assert {(r.clip_id, r.pair_no, r.prev_x, r.x) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize(
    "dc, dr, want",
    [
        (0, 0, (0.0, 0.0)),
        (-1, 0, (0.9361702127659575, -0.06382978723404255)),
        (0, 1, (-0.06382978723404255, -1.0638297872340425)),
    ],
)
def test_block_flow_golden(spark, dc, dr, want):
    r, c = np.mgrid[:8, :8]
    frames = {("a", 0): (c * c + r * r).astype(np.uint8), ("a", 1): ((c + dc) ** 2 + (r + dr) ** 2).astype(np.uint8)}
    pairs = motion.frame_pairs(gray_table(spark, frames), keep=("height", "width"))
    got = motion.block_flow(pairs, block=8).first()
    assert (got.u, got.v) == pytest.approx(want)


def test_constant_frames_do_not_move(spark):
    frames = {("a", n): np.full((H, W), 128, np.uint8) for n in range(4)}
    pairs = motion.frame_pairs(gray_table(spark, frames), keep=("height", "width"))
    flows = motion.flow_maps(pairs)
    clips = spark.createDataFrame([("a",), ("empty",)], "clip_id string")
    got = {r.clip_id: r.motion_flow for r in motion.motion_score(clips, flows).collect()}
    assert got["a"] == 0.0 and np.isnan(got["empty"])
    first = flows.first()
    assert flows.count() == 3 and (first.height, first.width, len(first.u)) == (6, 8, 48)


def test_flow_sign_follows_direction(spark):
    r, c = np.mgrid[:32, :32]
    wave = lambda s: (128 + 100 * np.sin((c + s) / 5) * np.cos(r / 7)).astype(np.uint8)
    frames = {("left", n): wave(n) for n in range(3)} | {("right", n): wave(-n) for n in range(3)}
    pairs = motion.frame_pairs(gray_table(spark, frames), keep=("height", "width"))
    clips = spark.createDataFrame([("left",), ("right",)], "clip_id string")
    score = {r.clip_id: r.motion_flow for r in motion.motion_score(clips, motion.flow_maps(pairs, 32)).collect()}
    assert score["left"] < -0.1 and score["right"] > 0.1


def test_plug_in_flow_downscale_and_score(spark):
    frames = {("a", n): pattern(1, n, 2) for n in range(3)}
    pairs = motion.frame_pairs(gray_table(spark, frames), keep=("height", "width"))
    flow = motion.dense_flow(pairs, lambda a, b: (a.astype("float32"), -2 * b.astype("float32")))
    small = motion.downscale_flow(flow).orderBy("pair_no").collect()
    assert [(r.height, r.width, len(r.u)) for r in small] == [(12, 16, 192)] * 2
    block = frames[("a", 0)].reshape(12, 4, 16, 4).mean(axis=(1, 3))
    assert np.allclose(np.array(small[0].u).reshape(12, 16), block, atol=1e-3)
    clips = spark.createDataFrame([("a",)], "clip_id string")
    full = motion.motion_score(clips, flow).first().motion_flow
    shrunk = motion.motion_score(clips, motion.downscale_flow(flow)).first().motion_flow
    want = np.mean([[frames[("a", n)].mean(), -2 * frames[("a", n + 1)].mean()] for n in range(2)])
    assert full == pytest.approx(want) and shrunk == pytest.approx(want, rel=1e-6)


def test_area_weights_of_uneven_shapes():
    w = area_weights(10, 4)
    assert np.allclose(w.sum(axis=1), 1) and np.allclose(w[0], [0.4, 0.4, 0.2] + [0] * 7)


def test_tracks(spark):
    rows = [
        ("a", 0, 0, 0.0, 0.0, 3.0, 4.0, 1), ("a", 1, 0, 0.0, 0.0, 9.0, 9.0, 0), ("a", 2, 0, 0.0, 0.0, 30.0, 40.0, 1),
        ("a", 0, 1, 0.0, 0.0, 6.0, 8.0, 1), ("b", 0, 0, 0.0, 0.0, 1.0, 1.0, 0),
    ]
    tracks = spark.createDataFrame(rows, "clip_id string, pair_no bigint, point_id int, x0 double, y0 double, x1 double, y1 double, status int")
    clips = spark.createDataFrame([("a",), ("b",), ("c",)], "clip_id string")
    got = {r.clip_id: r.motion_tracks for r in motion.track_motion(clips, tracks).collect()}
    assert got == {"a": 7.5, "b": 0.0, "c": 0.0}
