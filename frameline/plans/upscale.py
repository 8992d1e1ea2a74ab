"""The whole way of an image through a model: scale, split, pad, tile, infer, merge, crop, rejoin, round."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameline.operators import images as M
from frameline.operators.image_rows import map_images
from frameline.operators.infer import infer

# Sides of a padded image are a multiple of this for the given enlargement.
SIDE_MULTIPLE = {2: 2, 1: 4}


def upscale(
    images: DataFrame, loader: Callable[[str], object], predict: Callable[[object, np.ndarray, dict], np.ndarray], model_key: str,
    scale: int = 4, tile: int = 512, tile_pad: int = 10, pre_pad: int = 10,
) -> DataFrame:
    """Enlarged images of the same mode and depth, with the number of tiles the model failed on (left 0).

    Tiles are the unit of work, so one large image is handled by many tasks. Only image sizes, not pixels, are
    joined in for merging; pixels are shuffled once, to bring an image's tiles together.
    """
    ranged = M.normalize_range(images)
    kinds = ranged.select("image_id", "max_range")
    parts = M.split_mode(ranged).withColumn("image_id", F.col("image_id") * 2 + F.when(F.col("part") == "alpha", 1).otherwise(0))
    multiple = SIDE_MULTIPLE.get(scale, 1)

    def padded(side: str) -> str:
        return f"cast(ceil(({side} + {pre_pad}) / {multiple}) * {multiple} AS int)"

    sizes = parts.select("image_id", "mode", "part", F.col("h").alias("orig_h"), F.col("w").alias("orig_w"), "c")
    grids = sizes.withColumn("h", F.expr(padded("orig_h"))).withColumn("w", F.expr(padded("orig_w")))
    tiles = M.cut_tiles(M.pad_reflect(parts, pre_pad, multiple), tile, tile_pad)
    work = tiles.select(
        F.col("image_id").alias("job_id"), F.col("tile_id").alias("batch_id"), F.lit(None).cast("string").alias("output_file_path"),
        F.lit(model_key).alias("model_key"), "h", "w", "c", "data",
    )
    done = infer(work, loader, predict).filter("status = 200")
    merged = M.merge_tiles(done.withColumnRenamed("job_id", "image_id").withColumnRenamed("batch_id", "tile_id"), grids, tile, tile_pad, scale)
    whole = merged.join(sizes.drop("c"), "image_id").join(kinds.select(F.col("image_id").alias("source_id"), "max_range"), F.expr("image_id div 2 = source_id"))

    alpha = whole.filter("part = 'alpha'").select("source_id", F.col("data").alias("alpha_data"), F.col("w").alias("alpha_w"), F.col("missing").alias("alpha_missing"))
    color = whole.filter("part = 'color'").drop("image_id", "part").join(alpha, "source_id", "left").withColumnRenamed("source_id", "image_id")
    color = color.withColumn("missing", F.col("missing") + F.coalesce("alpha_missing", F.lit(0)))

    def rejoin(img: np.ndarray, mode: str, orig_h: int, orig_w: int, max_range: int, alpha_data: np.ndarray | None, alpha_w: int | None) -> np.ndarray:
        img = img[: orig_h * scale, : orig_w * scale]
        out = img[:, :, :1] if mode == "L" else img[:, :, ::-1]
        if alpha_data is not None:
            plane = alpha_data.reshape(-1, alpha_w, 1)
            out = np.concatenate([out, plane[: orig_h * scale, : orig_w * scale]], axis=2)
        return np.rint(np.clip(out, 0, 1) * max_range)

    return map_images(color, rejoin, ("image_id", "mode", "missing"), ("mode", "orig_h", "orig_w", "max_range", "alpha_data", "alpha_w"))
