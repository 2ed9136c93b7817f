"""Fetching images and composing collages. Pixels move once, already cut to their cells."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediabatch import schemas
from mediabatch.config import DEFAULT_CONFIG, ProcessingConfig
from mediabatch.functions.pixels import fill_crop, png_bytes, resize, stack, unstack
from mediabatch.functions.text import strip
from mediabatch.operators.layout import canvas_size, is_usable, place_images

# Only types that the image reader decodes are asked for.
HEADERS = {"User-Agent": "mediabatch", "Accept": "image/jpeg, image/png, image/gif, image/bmp"}

# Bytes of fetched bodies that a task hands on at a time.
FETCH_BYTES = 32 * 1024 * 1024

# Bytes of cells per batch between the two Python stages.
CELL_BYTES = 32 * 1024 * 1024

# Source pixels of equally large images that are resampled together, in bytes.
STACK_BYTES = 256 * 1024

# OpenCV type codes of the raw image struct, by channel count.
IMAGE_MODES = {1: 0, 3: 16, 4: 24}

SIZES = ["height", "width", "nChannels", "cell_w", "cell_h"]


# -- fetching ----------------------------------------------------------------------------------


def http_fetcher(url: str, timeout: int) -> tuple[str, bytes]:
    """(content type, body) of a URL; raises on any failure."""
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers=HEADERS), timeout=timeout) as answer:
        return answer.headers.get("content-type", ""), answer.read()


def _fetch_one(url: str, fetcher: Callable, timeout: int, retries: int, pause: Callable) -> tuple:
    """Try up to `retries` times with growing pauses; a reply that is no image is final."""
    started, error = time.monotonic(), None
    for attempt in range(retries):
        try:
            kind, body = fetcher(url, timeout)
        except Exception as problem:  # noqa: BLE001 - any failure of the injected fetcher is retried
            error = f"{type(problem).__name__}: {problem}"
            if attempt < retries - 1:
                pause(2**attempt)
            continue
        spent = int((time.monotonic() - started) * 1000)
        if not kind.lower().startswith("image/"):
            return attempt + 1, kind, None, "not an image", spent
        return attempt + 1, kind, body, None, spent
    return retries, None, None, error, int((time.monotonic() - started) * 1000)


def _fetch_some(urls: list[str], pool: ThreadPoolExecutor, workers: int, one: Callable) -> list[tuple]:
    """Replies to the first URLs, up to about `FETCH_BYTES` of bodies beyond the requests that are then open.

    Each worker takes the next URL when it is done with one, so a slow host keeps only its own worker.
    """
    replies: list = [None] * len(urls)
    turns, lock, held = iter(range(len(urls))), threading.Lock(), 0

    def work() -> None:
        nonlocal held
        while True:
            with lock:
                i = next(turns, None) if held < FETCH_BYTES else None
            if i is None:
                return
            replies[i] = one(urls[i])
            with lock:
                held += len(replies[i][2] or b"")

    for done in [pool.submit(work) for _ in range(min(workers, len(urls)))]:
        done.result()
    # URLs are taken in order, so those with a reply come first.
    return replies[: next(turns, len(urls))]


def fetch(
    rows: DataFrame,
    config: ProcessingConfig = DEFAULT_CONFIG,
    fetcher: Callable[[str, int], tuple[str, bytes]] = http_fetcher,
    url: str = "cover_url",
    tasks: int | None = None,
    pause: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Fetch every non-blank URL: adds attempts, content_type, bytes, error and fetch_ms.

    Rows are dealt out evenly over tasks (a creator's rows spread), each task keeps `max_workers`
    requests open and hands bytes on in groups of bounded size.
    """
    wanted = rows.where(strip(F.col(url)) != "")
    if tasks is None:
        # At least a few waves per core, to even out slow hosts.
        spark = rows.sparkSession
        tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = wanted.repartition(tasks)
    workers, timeout, retries = config.max_workers, config.timeout, config.max_retries
    names = ["attempts", "content_type", "bytes", "error", "fetch_ms"]

    def run(batches):
        with ThreadPoolExecutor(workers) as pool:
            for pdf in batches:
                urls = pdf[url].tolist()
                while urls:
                    got = _fetch_some(urls, pool, workers, lambda u: _fetch_one(u, fetcher, timeout, retries, pause))
                    part, pdf, urls = pdf.iloc[: len(got)], pdf.iloc[len(got) :], urls[len(got) :]
                    new = pd.DataFrame(got, columns=names, index=part.index)
                    yield pd.concat([part, new], axis=1)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields)
    return wanted.mapInPandas(run, f"{fields}, {schemas.FETCHED}")


def fetch_counts(fetched: DataFrame) -> DataFrame:
    """Images attempted, fetched and failed, with tries, bytes and time, per creator."""
    return fetched.groupBy("creator_name").agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col("error").isNull()).alias("fetched"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.sum("attempts").alias("attempts"),
        F.sum(F.length("bytes")).alias("bytes"),
        F.sum("fetch_ms").alias("fetch_ms"),
    )


# -- composing ---------------------------------------------------------------------------------


def _cells(sizes: pd.DataFrame, data: list, shape: Callable, cache: dict) -> list:
    """Each row's cell as bytes; None, where its pixels are unusable, leaves it blank."""
    cells: list = [None] * len(data)
    known = np.flatnonzero(sizes["nChannels"].isin(IMAGE_MODES))
    for size, at in sizes.iloc[known].groupby(list(sizes.columns), sort=False).indices.items():
        height, width, channels, cell_w, cell_h = map(int, size)
        length = height * width * channels
        whole = [i for i in known[at] if data[i] is not None and len(data[i]) == length]
        step = max(1, STACK_BYTES // max(length, 1))
        for start in range(0, len(whole), step):
            rows = whole[start : start + step]
            pixels = stack([data[i] for i in rows], height, width, channels)
            for i, cell in zip(rows, unstack(shape(pixels, cell_w, cell_h, cache), len(rows))):
                cells[i] = cell.tobytes()
    return cells


def _cut_cells(fit: str):
    def run(batches):
        cache: dict = {}
        shape = fill_crop if fit == "crop" else resize
        for pdf in batches:
            # The cells handed back at a time stay within a fixed number of bytes.
            step = max(1, CELL_BYTES // int((pdf["cell_w"] * pdf["cell_h"] * 3).max()))
            for start in range(0, len(pdf), step):
                part = pdf.iloc[start : start + step]
                started = time.monotonic()
                cells = _cells(part[SIZES], part["data"].tolist(), shape, cache)
                spent = (time.monotonic() - started) * 1000 / max(len(part), 1)
                out = part.drop(columns=["data", "height", "width", "nChannels"])
                yield out.assign(cell=cells, cell_ms=spent)

    return run


def _paste(labels: list[str], background: tuple[int, int, int], with_png: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        started = time.monotonic()
        canvas = np.empty((int(pdf["canvas_h"].iat[0]), int(pdf["canvas_w"].iat[0]), 3), np.uint8)
        canvas[:] = background[::-1]
        placed = 0
        for x, y, w, h, cell in zip(*(pdf[c].tolist() for c in ("x", "y", "cell_w", "cell_h", "cell"))):
            if cell is not None:
                canvas[y : y + h, x : x + w] = np.frombuffer(cell, np.uint8).reshape(h, w, 3)
                placed += 1
        out = {name: [pdf[name].iat[0]] for name in labels}
        out |= {"width": [canvas.shape[1]], "height": [canvas.shape[0]], "placed": [placed]}
        out["data"] = [canvas.tobytes()]
        if with_png:
            out["png"] = [png_bytes(canvas[:, :, ::-1])]
        out["compose_ms"] = [int(pdf["cell_ms"].sum() + (time.monotonic() - started) * 1000)]
        return pd.DataFrame(out)

    return run


def compose(
    images: DataFrame,
    rows: int = 5,
    cols: int = 7,
    target_width: int | None = None,
    target_height: int | None = None,
    fit: str = "stretch",
    background: tuple[int, int, int] = (255, 255, 255),
    keys=("creator_name",),
    order=("ord",),
    with_png: bool = False,
    sizes: DataFrame | None = None,
    creators: DataFrame | None = None,
    pixels: Column | None = None,
) -> DataFrame:
    """One collage per creator from rows with an `image` struct.

    Where `pixels` makes that struct from a row's other columns, the rows bring `width` and `height` instead: they are placed
    by these, and only placed images are made.

    Each task sends at most rows x cols images of a creator, once; there each is cut to its cell,
    and the small cells are regrouped for pasting, so a group carries at most rows x cols cells.
    `sizes` (keys, width, height of every image), where known, spares a second pass over pixels.
    `creators` (keys and further columns) adds those columns without moving pixels or canvases.
    Creators without a usable image have no collage row.
    """
    keys, order = list(keys), list(order)
    at = keys + [c for c in order if c not in keys]
    parts = [F.col(f"image.{n}").alias(n) for n in ("width", "height", "nChannels", "data")]
    flat = images.select(*at, *parts) if pixels is None else images
    if sizes is None:
        sizes = flat.select(*keys, "width", "height")
    canvas = canvas_size(sizes, rows, cols, target_width, target_height, fit, keys)
    carried: list[str] = []
    if creators is not None:
        carried = [c for c in creators.columns if c not in keys]
        canvas = canvas.join(creators, keys)
    cells = place_images(flat.where(is_usable()), canvas, rows, cols, keys, order)
    labels = keys + carried
    geometry = ["x", "y", "cell_w", "cell_h", "canvas_w", "canvas_h"]
    if pixels is not None:
        cells = cells.select(*labels, *geometry, pixels.alias("image")).select(*labels, *geometry, *parts)
    kinds = {f.name: f.dataType.simpleString() for f in cells.schema.fields}

    def fields(names):
        return ", ".join(f"`{n}` {kinds[n]}" for n in names)

    cut = cells.select(*labels, *geometry, "width", "height", "nChannels", "data").mapInPandas(
        _cut_cells(fit), f"{fields(labels + geometry)}, cell BINARY, cell_ms DOUBLE"
    )
    png = ", png BINARY" if with_png else ""
    collages = cut.groupBy(*keys).applyInPandas(
        _paste(labels, background, with_png),
        f"{fields(labels)}, width INT, height INT, placed INT, data BINARY{png}, compose_ms LONG",
    )
    packed = F.struct(
        F.lit("").alias("origin"),
        "height",
        "width",
        F.lit(3).alias("nChannels"),
        F.lit(IMAGE_MODES[3]).alias("mode"),
        "data",
    )
    extra = ["png"] if with_png else []
    return collages.select(*labels, "width", "height", "placed", packed.alias("image"), *extra, "compose_ms")


# -- duplicates --------------------------------------------------------------------------------


def image_duplicates(images: DataFrame, scope=("batch_id",), data: str = "data", order: str = "ord") -> DataFrame:
    """Content hash of each image and whether an earlier one in the same batch has it.

    Copies are counted before the shuffle; only hashes that repeat are joined back.
    """
    scope = list(scope)
    hashed = images.withColumn("image_hash", F.sha2(F.col(data), 256)).drop(data)
    repeated = (
        hashed.groupBy(*scope, "image_hash")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(order).alias("first_ord"))
        .where(F.col("copies") > 1)
    )
    return (
        hashed.join(repeated, [*scope, "image_hash"], "left")
        .withColumn("duplicate", F.coalesce(F.col(order) != F.col("first_ord"), F.lit(False)))
        .withColumn("copies", F.coalesce("copies", F.lit(1).cast("long")))
        .drop("first_ord")
    )
