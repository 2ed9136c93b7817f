import sys
import threading
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from mediabatch import schemas
from mediabatch.config import ProcessingConfig
from mediabatch.functions import pixels
from mediabatch.operators import compose, layout
from mediabatch.sources import readers

# The fetchers below run in Python tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

IMAGES = f"creator_name STRING, ord INT, image {schemas.IMAGE}"


def image(array):
    h, w, c = array.shape
    return ("", h, w, c, compose.IMAGE_MODES[c], array.tobytes())


def solid(width, height, bgr):
    return np.tile(np.array(bgr, np.uint8), (height, width, 1))


def sizes(spark, rows):
    return spark.createDataFrame(
        [(c, i, w, h) for i, (c, w, h) in enumerate(rows)], "creator_name string, ord int, width int, height int"
    )


# -- layout ------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "rows, options, expected",
    [
        ([("a", 40, 40)], {}, (300, 300)),
        ([("a", 100, 2000)], {}, (200, 800)),
        ([("a", 301, 250), ("a", 300, 251), ("a", 20, 9000)], {}, (300, 250)),
        ([("a", 100, 50), ("a", 100, 100)], {"target_width": 101}, (101, 75)),
        ([("a", 100, 50), ("a", 100, 100)], {"target_height": 101}, (151, 101)),
        ([("a", 100, 50)], {"target_width": 7, "target_height": 9}, (7, 9)),
    ],
)
def test_cell_size(spark, rows, options, expected):
    row = layout.cell_size(sizes(spark, rows), **options).first()
    assert (row.cell_w, row.cell_h) == expected


def test_grid_is_full_and_disjoint(spark):
    df = sizes(spark, [("a", 300, 300)] * 36 + [("b", 60, 500), ("b", 49, 500), ("b", 50, 50)])
    got = layout.grid_layout(df).collect()
    a = sorted((r for r in got if r.creator_name == "a"), key=lambda r: r.ord)
    assert len(a) == 35 and (a[-1].grid_row, a[-1].grid_col) == (4, 6)
    assert len({(r.x, r.y) for r in a}) == 35
    assert all(r.x + r.cell_w <= r.canvas_w and r.y + r.cell_h <= r.canvas_h for r in got)
    assert [(r.ord, r.grid_col) for r in sorted((r for r in got if r.creator_name == "b"), key=lambda r: r.ord)] == [
        (36, 0), (38, 1)]


def test_crop_grid_shrinks(spark):
    df = sizes(spark, [("a", 300, 300)] * 8)
    got = layout.grid_layout(df, fit="crop").collect()
    assert {(r.canvas_w, r.canvas_h, r.cell_w) for r in got} == {(1400, 400, 200)}


def test_combined_order(spark):
    names = ["b", "a", "b", "c", "a", "b"]
    df = spark.createDataFrame([(n, f"u{i}", i) for i, n in enumerate(names)],
                               "creator_name string, cover_url string, ord int")
    got = [r.cover_url for r in layout.combined_rows(df).orderBy("position").collect()]
    assert got == ["u0", "u2", "u5", "u1", "u4", "u3"]
    assert [r.cover_url for r in layout.combined_rows(df, 1, 1).orderBy("position").collect()] == got[:3]


def test_valid_images_need_a_matching_type(spark):
    df = spark.createDataFrame([(60, 60, "Image/PNG"), (60, 60, "text/html"), (60, 49, "image/png"), (-1, -1, "image/x")],
                               "width int, height int, content_type string")
    assert layout.valid_images(df).count() == 1


# -- pixels ------------------------------------------------------------------------------------


def slow_lanczos(line, size):
    """One line of values, resampled value by value."""
    scale = len(line) / size
    stretch = max(scale, 1.0)
    out = []
    for i in range(size):
        centre = (i + 0.5) * scale
        total = weight = 0.0
        for x, value in enumerate(line):
            d = (x + 0.5 - centre) / stretch
            if abs(d) < 3:
                k = np.sinc(d) * np.sinc(d / 3)
                total, weight = total + k * value, weight + k
        out.append(min(max(round(total / weight), 0), 255))
    return out


@pytest.mark.parametrize("size", [5, 40, 97])
def test_resample_line(size):
    line = np.random.default_rng(1).integers(0, 256, 40).astype(np.uint8)
    got = pixels.resize(np.repeat(line[None, :, None], 3, axis=2), size, 1, {})[0, :, 0]
    assert np.abs(got.astype(int) - slow_lanczos(line.tolist(), size)).max() <= 1


def test_resize_keeps_a_colour():
    out = pixels.resize(solid(77, 61, (3, 200, 255)), 200, 33, {})
    assert out.shape == (33, 200, 3) and (out == (3, 200, 255)).all()


def test_fill_crop_takes_the_centre():
    wide = np.concatenate([solid(100, 60, (0, 0, 0)), solid(60, 60, (9, 9, 9)), solid(100, 60, (0, 0, 0))], axis=1)
    out = pixels.fill_crop(wide, 30, 30, {})
    assert out.shape == (30, 30, 3) and (out[:, 5:25] == 9).all()


def test_png_decodes_in_spark(spark, tmp_path):
    rng = np.random.default_rng(2)
    rgb = rng.integers(0, 256, (60, 70, 3)).astype(np.uint8)
    (tmp_path / "a.png").write_bytes(pixels.png_bytes(rgb))
    (tmp_path / "junk.png").write_bytes(b"junk")
    got = {r.image.origin.rsplit("/", 1)[1]: r.image for r in readers.read_images(spark, str(tmp_path)).collect()}
    a = got["a.png"]
    back = np.frombuffer(bytes(a.data), np.uint8).reshape(a.height, a.width, 3)
    assert (back == rgb[:, :, ::-1]).all()
    assert got["junk.png"].width == -1


# -- composing ---------------------------------------------------------------------------------


def test_compose_places_cells(spark):
    grey = np.full((60, 60, 1), 7, np.uint8)
    alpha = np.tile(np.array([1, 2, 3, 0], np.uint8), (60, 60, 1))
    broken = ("", 60, 60, 3, 16, b"short")
    small = solid(10, 10, (9, 9, 9))
    rows = [("a", 3, image(grey)), ("a", 1, image(solid(80, 90, (10, 20, 30)))), ("a", 2, broken),
            ("a", 4, image(alpha)), ("a", 0, image(small)), ("only small", 0, image(small))]
    df = spark.createDataFrame(rows, IMAGES)
    got = compose.compose(df, 2, 2, 20, 30, background=(1, 2, 3), with_png=True).collect()
    assert [r.creator_name for r in got] == ["a"]
    row = got[0]
    canvas = np.frombuffer(bytes(row.image.data), np.uint8).reshape(60, 40, 3)
    assert (row.width, row.height, row.placed) == (40, 60, 3)
    assert (canvas[:30, :20] == (10, 20, 30)).all()
    assert (canvas[:30, 20:] == (3, 2, 1)).all()  # the broken image leaves the background
    assert (canvas[30:, :20] == 7).all()
    assert (canvas[30:, 20:] == (1, 2, 3)).all()
    assert bytes(row.png).startswith(b"\x89PNG")


def test_compose_equals_direct_resampling(spark):
    rng = np.random.default_rng(3)
    arrays = [rng.integers(0, 256, (50 + 7 * i, 60 + 5 * i, 3)).astype(np.uint8) for i in range(7)]
    df = spark.createDataFrame([("a", i, image(x)) for i, x in enumerate(arrays)], IMAGES)
    row = compose.compose(df, 2, 3).first()
    canvas = np.frombuffer(bytes(row.image.data), np.uint8).reshape(400, 600, 3)
    for i, x in enumerate(arrays[:6]):
        cell = canvas[i // 3 * 200 : i // 3 * 200 + 200, i % 3 * 200 : i % 3 * 200 + 200]
        assert (cell == pixels.resize(x, 200, 200, {})).all()


def test_pixels_are_cut_before_the_shuffle_on_creator(spark):
    df = spark.createDataFrame([("a", 1, image(solid(60, 60, (1, 1, 1))))], IMAGES)
    plan = compose.compose(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("FlatMapGroupsInPandas") < plan.index("MapInPandas", plan.index("FlatMapGroupsInPandas") + 25)


def test_duplicates(spark, rows_of):
    df = spark.createDataFrame([("b1", 1, b"x"), ("b1", 2, b"x"), ("b1", 3, b"y"), ("b2", 4, b"x")],
                               "batch_id string, ord int, data binary")
    got = rows_of(compose.image_duplicates(df), "ord", "copies", "duplicate")
    assert got == [(1, 2, False), (2, 2, True), (3, 1, False), (4, 1, False)]


# -- fetching ----------------------------------------------------------------------------------


def flaky(url, timeout):
    kind = url.rsplit("/", 1)[1]
    if kind == "down":
        raise OSError("no route")
    return ("text/html" if kind == "page" else "IMAGE/png"), f"{url}:{timeout}".encode()


def test_fetch(spark):
    urls = ["h/ok", "h/page", "h/down", "  "]
    df = spark.createDataFrame([("a", u, i) for i, u in enumerate(urls)],
                               "creator_name string, cover_url string, ord int")
    config = ProcessingConfig(max_retries=3, timeout=4)
    fetched = compose.fetch(df, config, flaky, tasks=2, pause=lambda s: None)
    got = {r.cover_url: r for r in fetched.collect()}
    assert set(got) == {"h/ok", "h/page", "h/down"}
    assert bytes(got["h/ok"].bytes) == b"h/ok:4" and got["h/ok"].attempts == 1
    assert got["h/page"].error == "not an image" and got["h/page"].attempts == 1 and got["h/page"].bytes is None
    assert got["h/down"].error == "OSError: no route" and got["h/down"].attempts == 3
    row = compose.fetch_counts(fetched).first()
    assert (row.attempted, row.fetched, row.failed) == (3, 1, 2)


def test_retries_back_off():
    waits = []
    out = compose._fetch_one("h/down", flaky, 1, 4, waits.append)
    assert waits == [1, 2, 4] and out[0] == 4


def test_cap_before_the_fetch(spark):
    from mediabatch.operators.ingest import cap_per_creator

    df = spark.range(100).select(F.lit("a").alias("creator_name"), F.col("id").alias("ord"),
                                 F.concat(F.lit("h/"), F.col("id")).alias("cover_url"))
    fetched = compose.fetch(cap_per_creator(df, 9), ProcessingConfig(), flaky)
    assert fetched.count() == 9


def test_only_placed_images_are_made(spark):
    """A row beyond the grid or too small is never made: its pixels would end the job."""
    rows = [("a", i, 60, 60 if i != 1 else 40) for i in range(9)]
    df = spark.createDataFrame(rows, "creator_name string, ord int, width int, height int").repartition(3)
    made = F.when(F.col("ord").isin(0, 2, 3, 4), F.unhex(F.repeat(F.lit("07"), 3600))).otherwise(
        F.raise_error(F.lit("made without need")).cast("binary")
    )
    struct = F.struct("width", "height", F.lit(1).alias("nChannels"), made.alias("data"))
    row = compose.compose(df, 2, 2, 20, 30, pixels=struct).first()
    assert (row.placed, set(row.image.data)) == (4, {7})


def test_images_of_one_size_resampled_together():
    rng = np.random.default_rng(3)
    for channels in (1, 3, 4):
        raw = [rng.integers(0, 256, (9, 13, channels), np.uint8).tobytes() for _ in range(5)]
        for shape in (pixels.resize, pixels.fill_crop):
            together = pixels.unstack(shape(pixels.stack(raw, 9, 13, channels), 7, 5, {}), 5)
            alone = [shape(pixels.to_array(data, 9, 13, channels), 7, 5, {}) for data in raw]
            assert np.array_equal(together, alone)


def test_fetch_slow_host_holds_one_worker_and_bodies_stay_bounded(monkeypatch):
    """While one URL hangs, the other worker goes through all others; a group ends when its bodies are large enough."""
    others, hung = threading.Event(), []

    def one(url):
        if url == 0:
            hung.append(others.wait(20))
        elif url == 99:
            others.set()
        return 1, "image/png", b"x" * 10, None, url

    with ThreadPoolExecutor(2) as pool:
        got = compose._fetch_some(list(range(100)), pool, 2, one)
        assert hung == [True] and [r[4] for r in got] == list(range(100))
        monkeypatch.setattr(compose, "FETCH_BYTES", 50)
        got = compose._fetch_some(list(range(1, 99)), pool, 2, one)
    assert 5 <= len(got) <= 7 and [r[4] for r in got] == list(range(1, len(got) + 1))
