"""Image-table work around a model: scaling, channels, padding, tiles, blocks, resampling.

An image is one row ``(image_id, h, w, c, data)`` with row-major interleaved values. Steps on single images
are narrow; only putting tiles together again shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frameline.functions import pixels as P
from frameline.operators.image_rows import expand_images, map_images

# A larger maximum than this means 16-bit input; ranges of the two depths.
EIGHT_BIT_LIMIT = 256
RANGE_8, RANGE_16 = 255, 65535


def value_range(data: Column) -> Column:
    return F.when(F.array_max(data) > EIGHT_BIT_LIMIT, RANGE_16).otherwise(RANGE_8)


def normalize_range(images: DataFrame) -> DataFrame:
    """Values to [0, 1]; ``max_range`` tells the depth for :func:`quantize`."""
    ranged = images.withColumn("max_range", value_range(F.col("data")))
    return ranged.withColumn("data", F.transform("data", lambda v: v / F.col("max_range")))


def quantize(images: DataFrame) -> DataFrame:
    """Clamp to [0, 1], scale to ``max_range``, round half to even."""
    def step(v: Column) -> Column:
        return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)) * F.col("max_range"))

    return images.withColumn("data", F.transform("data", step))


def split_mode(images: DataFrame) -> DataFrame:
    """Colour part in RGB order per image and, for four channels, the alpha part; gray is repeated three times."""
    def split(img: np.ndarray, _: dict):
        channels = img.shape[2]
        if channels == 1:
            return ((("L", "color"), np.repeat(img, 3, axis=2)),)
        mode = "RGBA" if channels == 4 else "RGB"
        color = ((mode, "color"), img[:, :, 2::-1])
        return (color, ((mode, "alpha"), img[:, :, 3:4])) if channels == 4 else (color,)

    return expand_images(images, split, extras=(("mode", T.StringType()), ("part", T.StringType())))


def merge_alpha(color: DataFrame, alpha: DataFrame, scale: int = 1) -> DataFrame:
    """BGRA image from an RGB image and its alpha plane; an alpha of the old size is enlarged bilinearly."""
    def merge(img: np.ndarray, alpha_data: np.ndarray, alpha_h: int, alpha_w: int) -> np.ndarray:
        plane = alpha_data.reshape(alpha_h, alpha_w, 1)
        if plane.shape[:2] != img.shape[:2]:
            plane = P.resize(plane, img.shape[0], img.shape[1], "bilinear")
        return np.concatenate([img[:, :, ::-1], plane], axis=2)

    planes = alpha.select("image_id", F.col("data").alias("alpha_data"), F.col("h").alias("alpha_h"), F.col("w").alias("alpha_w"))
    return map_images(color.join(planes, "image_id"), merge, params=("alpha_data", "alpha_h", "alpha_w"))


def pad_reflect(images: DataFrame, pre_pad: int = 10, multiple: int | None = None) -> DataFrame:
    return map_images(images, lambda img: P.pad_reflect(img, pre_pad, multiple))


def pad_flip(images: DataFrame, window: int = 8) -> DataFrame:
    return map_images(images, lambda img: P.pad_flip(img, window))


def crop_output(images: DataFrame, scale: int) -> DataFrame:
    """Cuts a padded, enlarged image back to its first size times ``scale`` (``orig_h``, ``orig_w``)."""
    return map_images(images, lambda img, orig_h, orig_w: img[: orig_h * scale, : orig_w * scale], params=("orig_h", "orig_w"))


def tile_grid(images: DataFrame, tile: int, pad: int, scale: int = 1) -> DataFrame:
    """One row per tile: 1-based row-major id, core box, padded box clipped to the image, box in the output.

    Boxes are half open. Pure arithmetic on the image size.
    """
    rows = images.selectExpr(
        "image_id", "h", "w", "c",
        f"cast(ceil(h / {tile}) AS int) AS tiles_y", f"cast(ceil(w / {tile}) AS int) AS tiles_x",
    )
    rows = rows.select("*", F.explode(F.expr("sequence(0, tiles_y - 1)")).alias("ty"))
    rows = rows.select("*", F.explode(F.expr("sequence(0, tiles_x - 1)")).alias("tx"))
    rows = rows.selectExpr(
        "image_id", "h", "w", "c", "ty", "tx", "ty * tiles_x + tx + 1 AS tile_id",
        f"ty * {tile} AS y0", f"least(ty * {tile} + {tile}, h) AS y1", f"tx * {tile} AS x0", f"least(tx * {tile} + {tile}, w) AS x1",
    )
    return rows.selectExpr(
        "*", f"greatest(y0 - {pad}, 0) AS pad_y0", f"least(y1 + {pad}, h) AS pad_y1", f"greatest(x0 - {pad}, 0) AS pad_x0", f"least(x1 + {pad}, w) AS pad_x1",
        f"y0 * {scale} AS out_y0", f"y1 * {scale} AS out_y1", f"x0 * {scale} AS out_x0", f"x1 * {scale} AS out_x1",
    )


def tile_pixels(pixels: DataFrame, sizes: DataFrame, tile: int, pad: int) -> DataFrame:
    """Every (tile, pixel) pair with the pixel inside the tile's padded box, for the pixel form.

    The tiles covering a coordinate are ``(v - pad) div tile .. (v + pad) div tile``, so each pixel is repeated
    for its own tiles and no range join takes place. ``sizes`` is one row per image.
    """
    known = pixels if {"h", "w"} <= set(pixels.columns) else pixels.join(sizes.select("image_id", "h", "w"), "image_id")

    def covering(v: str, n: str) -> str:
        return f"explode(sequence(cast(greatest(floor(({v} - {pad}) / {tile}), 0) AS int), cast(least(floor(({v} + {pad}) / {tile}), ceil({n} / {tile}) - 1) AS int)))"

    both = known.selectExpr("*", f"{covering('y', 'h')} AS ty").selectExpr("*", f"{covering('x', 'w')} AS tx")
    return both.selectExpr("image_id", f"cast(ty * ceil(w / {tile}) + tx + 1 AS int) AS tile_id", "y", "x", "c", "v")


def cut_tiles(images: DataFrame, tile: int, pad: int) -> DataFrame:
    """Padded tiles as rows, so that one large image spreads over many tasks."""
    def cut(img: np.ndarray, _: dict):
        h, w = img.shape[:2]
        across = -(-w // tile)
        for ty in range(-(-h // tile)):
            for tx in range(across):
                y0, x0 = max(ty * tile - pad, 0), max(tx * tile - pad, 0)
                yield (ty * across + tx + 1,), img[y0: min((ty + 1) * tile, h) + pad, x0: min((tx + 1) * tile, w) + pad]

    return expand_images(images, cut, extras=(("tile_id", T.IntegerType()),))


def merge_tiles(tiles: DataFrame, sizes: DataFrame, tile: int, pad: int, scale: int = 1) -> DataFrame:
    """Enlarged tiles put together without their pads; ``missing`` counts tiles that were not there (left 0).

    ``sizes`` is one row ``image_id, h, w, c`` per source image. The tiles of an image meet in the one row
    that is the image, so a group is never larger than an output row; their values are shuffled once.
    """
    ordered = F.array_sort(F.collect_list(F.struct("tile_id", "data")))
    found = tiles.groupBy("image_id").agg(
        F.transform(ordered, lambda t: t["tile_id"]).alias("tile_ids"), F.flatten(F.transform(ordered, lambda t: t["data"])).alias("data")
    )

    def paste(flat: np.ndarray | None, size: dict):
        h, w, c = size["h"], size["w"], size["c"]
        out = np.zeros((h * scale, w * scale, c))
        across, down, at = -(-w // tile), -(-h // tile), 0
        for tile_id in () if flat is None else size["tile_ids"]:
            ty, tx = divmod(int(tile_id) - 1, across)
            y0, y1, x0, x1 = ty * tile, min((ty + 1) * tile, h), tx * tile, min((tx + 1) * tile, w)
            py0, px0 = max(y0 - pad, 0), max(x0 - pad, 0)
            rows, columns = (min(y1 + pad, h) - py0) * scale, (min(x1 + pad, w) - px0) * scale
            block = flat[at: at + rows * columns * c].reshape(rows, columns, c)
            at += block.size
            top, left = (y0 - py0) * scale, (x0 - px0) * scale
            out[y0 * scale: y1 * scale, x0 * scale: x1 * scale] = block[top: top + (y1 - y0) * scale, left: left + (x1 - x0) * scale]
        yield (across * down - (0 if flat is None else len(size["tile_ids"])),), out

    rows = sizes.select("image_id", "h", "w", "c").join(found, "image_id", "left")
    return expand_images(rows, paste, params=("h", "w", "c", "tile_ids"), extras=(("missing", T.IntegerType()),), shaped=False)


STRIPE_BYTES = 64 << 20


def stripe_rows(w: int, c: int, scale: int = 1, stripe_bytes: int = STRIPE_BYTES) -> int:
    """Output rows of a stripe: as many as fit (values take 8 bytes), one at least."""
    return max(1, stripe_bytes // (w * scale * c * 8))


def merge_stripes(tiles: DataFrame, sizes: DataFrame, tile: int, pad: int, scale: int = 1, stripe_bytes: int = STRIPE_BYTES) -> DataFrame:
    """As :func:`merge_tiles` for images of any size: an output image is rows of its own, one for each stripe.

    A stripe is as many full output rows as ``stripe_bytes`` hold; ``stripe`` numbers them from the top and ``y0`` is the
    first output row. Tiles lose their pads and are cut along the stripes before anything is shuffled, so neither a group
    nor a row is larger than a stripe. ``missing`` counts the tiles a stripe should have had (their place stays 0); a
    stripe without any tile is there too.
    """
    size = sizes.select("image_id", F.col("h").alias("full_h"), F.col("w").alias("full_w"), F.col("c").alias("full_c"))

    def cut(img: np.ndarray, row: dict):
        h, w, rows = row["full_h"], row["full_w"], stripe_rows(row["full_w"], row["full_c"], scale, stripe_bytes)
        ty, tx = divmod(int(row["tile_id"]) - 1, -(-w // tile))
        y0, y1, x0, x1 = ty * tile, min((ty + 1) * tile, h), tx * tile, min((tx + 1) * tile, w)
        top, left = (y0 - max(y0 - pad, 0)) * scale, (x0 - max(x0 - pad, 0)) * scale
        core = img[top: top + (y1 - y0) * scale, left: left + (x1 - x0) * scale]
        for stripe in range(y0 * scale // rows, (y1 * scale - 1) // rows + 1):
            first, last = max(stripe * rows, y0 * scale), min((stripe + 1) * rows, y1 * scale)
            yield (stripe, first - stripe * rows, x0 * scale), core[first - y0 * scale: last - y0 * scale]

    places = [(name, T.IntegerType()) for name in ("stripe", "top", "left")]
    pieces = expand_images(tiles.join(size, "image_id"), cut, params=("tile_id", "full_h", "full_w", "full_c"), extras=places)
    ordered = F.array_sort(F.collect_list(F.struct("top", "left", "h", "w", "data")))
    found = pieces.groupBy("image_id", "stripe").agg(
        *[ordered[n].alias(f"at_{n}") for n in ("top", "left", "h", "w")], F.flatten(F.transform(ordered, lambda p: p["data"])).alias("data")
    )
    rows = F.greatest(F.lit(1), F.floor(F.lit(stripe_bytes) / (F.col("w") * scale * F.col("c") * 8))).cast("int")
    stripes = F.sequence(F.lit(0), F.ceil(F.col("h") * scale / F.col("rows")).cast("int") - 1)
    every = sizes.select("image_id", "h", "w", "c", rows.alias("rows")).select("*", F.explode(stripes).alias("stripe"))

    def paste(flat: np.ndarray | None, row: dict):
        first = row["stripe"] * row["rows"]
        last = min(first + row["rows"], row["h"] * scale)
        out = np.zeros((last - first, row["w"] * scale, row["c"]))
        at = 0
        for top, left, h, w in () if flat is None else zip(*(row[f"at_{n}"] for n in ("top", "left", "h", "w"))):
            out[top: top + h, left: left + w] = flat[at: at + h * w * row["c"]].reshape(h, w, row["c"])
            at += h * w * row["c"]
        down = (last - 1) // (tile * scale) - first // (tile * scale) + 1
        yield (-(-row["w"] // tile) * down - (0 if flat is None else len(row["at_top"])), first), out

    params = ("stripe", "rows", "h", "w", "c", "at_top", "at_left", "at_h", "at_w")
    extras = (("missing", T.IntegerType()), ("y0", T.IntegerType()))
    return expand_images(every.join(found, ["image_id", "stripe"], "left"), paste, ("image_id", "stripe"), params, extras, shaped=False)


def to_blocks(images: DataFrame, window: int) -> DataFrame:
    """Non-overlapping blocks; image sides must be multiples of the window."""
    def cut(img: np.ndarray, _: dict):
        for by in range(img.shape[0] // window):
            for bx in range(img.shape[1] // window):
                yield (by, bx), img[by * window: (by + 1) * window, bx * window: (bx + 1) * window]

    return expand_images(images, cut, extras=(("block_y", T.IntegerType()), ("block_x", T.IntegerType())))


def from_blocks(blocks: DataFrame, sizes: DataFrame, window: int) -> DataFrame:
    """Inverse of :func:`to_blocks`; ``sizes`` gives ``image_id, h, w, c``."""
    across = sizes.select("image_id", F.expr(f"cast(w div {window} AS int)").alias("_across"))
    numbered = blocks.join(across, "image_id").withColumn("tile_id", F.col("block_y") * F.col("_across") + F.col("block_x") + 1)
    return merge_tiles(numbered, sizes, window, 0).drop("missing")


def depth_to_space(images: DataFrame, r: int) -> DataFrame:
    return map_images(images, lambda img: P.depth_to_space(img, r))


def space_to_depth(images: DataFrame) -> DataFrame:
    return map_images(images, P.space_to_depth)


def upsample_nearest(images: DataFrame, s: int, keep: Sequence[str] = ("image_id",)) -> DataFrame:
    return map_images(images, lambda img: P.upsample_nearest(img, s), keep)


def resize_to(images: DataFrame, outscale: float, mode: str = "lanczos4") -> DataFrame:
    """To the first size (``orig_h``, ``orig_w``) times ``outscale``, cut to whole pixels."""
    def fit(img: np.ndarray, orig_h: int, orig_w: int) -> np.ndarray:
        return P.resize(img, int(orig_h * outscale), int(orig_w * outscale), mode)

    return map_images(images, fit, params=("orig_h", "orig_w"))


def normalize(images: DataFrame, mean: Sequence[float], std: Sequence[float]) -> DataFrame:
    m, s = np.asarray(mean, dtype=float), np.asarray(std, dtype=float)
    return map_images(images, lambda img: (img - m) / s)
