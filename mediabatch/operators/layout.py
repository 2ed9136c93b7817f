"""Cell sizes and grid positions, as plain columns; no pixels here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Smallest usable image side, cell side limits, cell side without images.
MIN_IMAGE_SIDE = 50
MIN_CELL, MAX_CELL, EMPTY_CELL = 200, 800, 300

# Combined mode takes this many times the number of cells, to allow for failed downloads.
COMBINED_SURPLUS = 3


def is_usable() -> Column:
    ok = (F.col("width") >= MIN_IMAGE_SIDE) & (F.col("height") >= MIN_IMAGE_SIDE)
    return F.coalesce(ok, F.lit(False))


def valid_images(images: DataFrame) -> DataFrame:
    """Decoded images that are large enough; a content type, where known, must be an image's."""
    out = images.where(is_usable())
    if "content_type" in images.columns:
        out = out.where(F.startswith(F.lower("content_type"), F.lit("image/")))
    return out


def cell_size(
    images: DataFrame, target_width: int | None = None, target_height: int | None = None, keys=("creator_name",)
) -> DataFrame:
    """Common cell size per creator over its usable images: (keys, images, cell_w, cell_h).

    Without targets the mean size, truncated and clamped; one target keeps the mean proportion.
    A creator without usable images gets 300 x 300.
    """
    ok = is_usable()
    w, h = F.when(ok, F.col("width")), F.when(ok, F.col("height"))

    def clamped(mean: Column) -> Column:
        return F.least(F.greatest(mean.cast("int"), F.lit(MIN_CELL)), F.lit(MAX_CELL))

    if target_width and target_height:
        cw, ch = F.lit(target_width), F.lit(target_height)
    elif target_width:
        cw, ch = F.lit(target_width), (F.avg(h / w) * target_width).cast("int")
    elif target_height:
        cw, ch = (F.avg(w / h) * target_height).cast("int"), F.lit(target_height)
    else:
        cw, ch = clamped(F.avg(w)), clamped(F.avg(h))
    n = F.count(w)
    return images.groupBy(*keys).agg(
        n.alias("images"),
        F.when(n > 0, cw).otherwise(F.lit(EMPTY_CELL)).alias("cell_w"),
        F.when(n > 0, ch).otherwise(F.lit(EMPTY_CELL)).alias("cell_h"),
    )


def canvas_size(
    images: DataFrame,
    rows: int = 5,
    cols: int = 7,
    target_width: int | None = None,
    target_height: int | None = None,
    fit: str = "stretch",
    keys=("creator_name",),
) -> DataFrame:
    """One row per creator: (keys, cell_w, cell_h, canvas_w, canvas_h).

    `fit="crop"` is the square variant: 200 px cells and only as many grid rows as needed.
    """
    if fit == "crop":
        sizes = images.groupBy(*keys).agg(F.count_if(is_usable()).alias("images")).withColumns(
            {"cell_w": F.lit(MIN_CELL), "cell_h": F.lit(MIN_CELL)}
        )
        grid_rows = F.ceil(F.least(F.col("images"), F.lit(rows * cols)) / cols).cast("int")
    else:
        sizes = cell_size(images, target_width, target_height, keys)
        grid_rows = F.lit(rows)
    return sizes.select(
        *keys,
        "cell_w",
        "cell_h",
        (F.col("cell_w") * cols).alias("canvas_w"),
        (F.col("cell_h") * grid_rows).alias("canvas_h"),
    )


def place_images(usable: DataFrame, canvas: DataFrame, rows: int, cols: int, keys: list[str], order) -> DataFrame:
    """The first rows x cols images per creator with their cell.

    The row number limit cuts every group before the shuffle; the canvas rows are joined on the same
    keys, so the images move once.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    placed = usable.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= rows * cols)
    i = F.col("_n") - 1
    return (
        placed.join(canvas, keys)
        .withColumns({"grid_row": F.floor(i / cols).cast("int"), "grid_col": (i % cols).cast("int")})
        .withColumns({"x": F.col("grid_col") * F.col("cell_w"), "y": F.col("grid_row") * F.col("cell_h")})
        .drop("_n")
    )


def grid_layout(
    images: DataFrame,
    rows: int = 5,
    cols: int = 7,
    target_width: int | None = None,
    target_height: int | None = None,
    fit: str = "stretch",
    keys=("creator_name",),
    order=("ord",),
) -> DataFrame:
    """Cell and canvas of every placed image: the first rows x cols usable ones per creator."""
    keys = list(keys)
    extra = [c for c in order if c not in keys]
    usable = valid_images(images).select(*keys, *extra, "width", "height")
    canvas = canvas_size(images, rows, cols, target_width, target_height, fit, keys)
    return place_images(usable, canvas, rows, cols, keys, order)


def combined_rows(items: DataFrame, rows: int = 5, cols: int = 7, keep=("cover_url",)) -> DataFrame:
    """The rows of one combined collage: creators by first appearance, then file order.

    Only the first rows x cols x 3 rows are wanted, hence at most that many creators: those with the
    earliest first rows, a set of fixed size, are broadcast, and the rest is a top-n.
    """
    wanted = rows * cols * COMBINED_SURPLUS
    first = (
        items.groupBy("creator_name")
        .agg(F.min("ord").alias("first_ord"))
        .orderBy("first_ord")
        .limit(wanted)
    )
    top = (
        items.join(F.broadcast(first), "creator_name")
        .orderBy("first_ord", "ord")
        .limit(wanted)
        .select("creator_name", "ord", "first_ord", *keep)
    )
    # At most `wanted` rows are left to number.
    position = F.row_number().over(Window.orderBy("first_ord", "ord"))
    return top.withColumn("position", position).drop("first_ord")


def combined_layout(images: DataFrame, rows: int = 5, cols: int = 7, **targets) -> DataFrame:
    """Layout of the single combined collage, under the creator label `combined`."""
    chosen = combined_rows(images, rows, cols, keep=("width", "height")).select(
        F.lit("combined").alias("creator_name"), F.col("position").alias("ord"), "width", "height",
        F.col("creator_name").alias("source_creator"), F.col("ord").alias("source_ord"),
    )
    layout = grid_layout(chosen, rows, cols, **targets)
    return layout.join(chosen.select("ord", "source_creator", "source_ord"), "ord")
