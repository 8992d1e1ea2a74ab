"""Low/high quality training pairs: draws, degradation, crops, augmentation, pairing and mixing.

All draws are functions of (seed, image id), so both sides of a pair, and a task that is run again, get the
same ones without a join. Degradation is one narrow pass over the images.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameline.functions import draws as D
from frameline.functions import names
from frameline.functions import pixels as P
from frameline.functions.sizing import int_div
from frameline.operators.image_rows import map_images
from frameline.operators.skew import ranked_in_group
from frameline.session import scratch_dir

# Blur kernel kinds and kernel sizes.
KERNELS = ("iso", "aniso", "generalized_iso", "generalized_aniso", "plateau_iso", "plateau_aniso")
SMALLEST_KERNEL, KERNEL_SIZES, LARGEST_KERNEL = 7, 8, 21
WIDE_KERNEL = 13
RESIZE_MODES = ("area", "bilinear", "bicubic")


@dataclass(frozen=True)
class Stage:
    """Settings of one degradation round; defaults are the published ones of the first round."""

    sinc_prob: float = 0.1
    kernel_prob: tuple[float, ...] = (0.45, 0.25, 0.12, 0.03, 0.12, 0.03)
    blur_sigma: tuple[float, float] = (0.2, 3.0)
    betag: tuple[float, float] = (0.5, 4.0)
    betap: tuple[float, float] = (1.0, 2.0)
    blur_prob: float = 1.0
    resize_prob: tuple[float, float, float] = (0.2, 0.7, 0.1)
    resize_range: tuple[float, float] = (0.15, 1.5)
    gaussian_prob: float = 0.5
    noise_range: tuple[float, float] = (1.0, 30.0)
    poisson_range: tuple[float, float] = (0.05, 3.0)
    gray_prob: float = 0.4
    jpeg_range: tuple[float, float] = (30.0, 95.0)


SECOND = Stage(
    blur_sigma=(0.2, 1.5), blur_prob=0.8, resize_prob=(0.3, 0.4, 0.3), resize_range=(0.3, 1.2), noise_range=(1.0, 25.0), poisson_range=(0.05, 2.5)
)


@dataclass(frozen=True)
class Recipe:
    first: Stage = Stage()
    second: Stage = SECOND
    final_sinc_prob: float = 0.8
    scale: int = 4


def _kernel_size(u: Column) -> Column:
    return (F.floor(u * KERNEL_SIZES) * 2 + SMALLEST_KERNEL).cast("int")


def _stage_draws(stage: Stage, name: str, u: Callable[[str], Column]) -> dict[str, Column]:
    size = _kernel_size(u("size"))
    cutoff_low = F.when(size < WIDE_KERNEL, math.pi / 3).otherwise(math.pi / 5)
    kernel = F.when(u("sinc") < stage.sinc_prob, "sinc").otherwise(D.choice(u("kernel"), KERNELS, stage.kernel_prob))
    plateau = kernel.startswith("plateau")
    low, high = (F.when(plateau, stage.betap[i]).otherwise(stage.betag[i]) for i in (0, 1))
    beta = F.when(u("beta_side") < 0.5, D.between(u("beta"), low, F.lit(1.0))).otherwise(D.between(u("beta"), F.lit(1.0), high))
    resize = D.choice(u("resize"), ("up", "down", "keep"), stage.resize_prob)
    factor = F.when(resize == "up", D.between(u("factor"), 1.0, stage.resize_range[1])).when(
        resize == "down", D.between(u("factor"), stage.resize_range[0], 1.0)).otherwise(1.0)
    noise = F.when(u("noise") < stage.gaussian_prob, "gaussian").otherwise("poisson")
    level = F.when(noise == "gaussian", D.between(u("level"), *stage.noise_range)).otherwise(D.between(u("level"), *stage.poisson_range))
    columns = {
        "size": size, "kernel": kernel, "cutoff": D.between(u("cutoff"), cutoff_low, math.pi),
        "sigma_x": D.between(u("sigma_x"), *stage.blur_sigma), "sigma_y": D.between(u("sigma_y"), *stage.blur_sigma),
        "angle": D.between(u("angle"), -math.pi, math.pi), "beta": beta, "blur": u("blur") < stage.blur_prob,
        "resize": resize, "factor": factor, "mode": D.choice(u("mode"), RESIZE_MODES),
        "noise": noise, "level": level, "gray": u("gray") < stage.gray_prob, "jpeg": D.between(u("jpeg"), *stage.jpeg_range),
    }
    return {f"{name}_{k}": v for k, v in columns.items()}


def draw_params(images: DataFrame, recipe: Recipe = Recipe(), seed: int = 0) -> DataFrame:
    """Adds a ``draw`` struct with every choice of the degradation of an image. Narrow, JVM only."""
    def u(stage: str) -> Callable[[str], Column]:
        return lambda name: D.uniform(seed, F.col("image_id"), stage, name)

    last = u("final")
    columns = {
        **_stage_draws(recipe.first, "first", u("first")), **_stage_draws(recipe.second, "second", u("second")),
        "final_sinc": last("sinc") < recipe.final_sinc_prob, "final_size": _kernel_size(last("size")),
        "final_cutoff": D.between(last("cutoff"), math.pi / 3, math.pi), "final_mode": D.choice(last("mode"), RESIZE_MODES),
        "resize_before_jpeg": last("order") < 0.5,
    }
    return images.withColumn("draw", F.struct(*[v.alias(k) for k, v in columns.items()]))


def fit_size(images: DataFrame, size: int = 400, seed: int = 0) -> DataFrame:
    """Ground truth to ``size`` x ``size``: reflect pad when smaller, random crop when larger."""
    def fit(img: np.ndarray, top_u: float, left_u: float) -> np.ndarray:
        h, w = img.shape[:2]
        img = P.pad_bottom_right(img, max(0, size - h), max(0, size - w), "reflect")
        top, left = int(top_u * (img.shape[0] - size + 1)), int(left_u * (img.shape[1] - size + 1))
        return img[top: top + size, left: left + size]

    drawn = images.withColumn("top_u", D.uniform(seed, F.col("image_id"), "top")).withColumn("left_u", D.uniform(seed, F.col("image_id"), "left"))
    return map_images(drawn, fit, params=("top_u", "left_u"))


def filter2d(images: DataFrame, kernel: str = "kernel") -> DataFrame:
    """Filters each image with its own square kernel (array column, row-major)."""
    def run(img: np.ndarray, **row: np.ndarray) -> np.ndarray:
        side = math.isqrt(len(row[kernel]))
        return P.filter2d(img, row[kernel].reshape(side, side))

    return map_images(images, run, params=(kernel,))


def resize(images: DataFrame, h: int, w: int, mode: str) -> DataFrame:
    return map_images(images, lambda img: P.resize(img, h, w, mode))


GRAY = (0.2989, 0.587, 0.114)  # fixed value: weights of a pixel's channels in gray noise


def _noisy(img: np.ndarray, kind: str, level: float, gray: bool, key: int) -> np.ndarray:
    source = img @ np.array(GRAY) if gray and img.shape[2] == 3 else img
    source = source[..., None] if source.ndim == 2 else source
    if kind == "gaussian":
        noise = D.place_normals(key, source.size).reshape(source.shape) * (level / 255.0)
    else:
        whole = np.clip(np.round(np.round(source * 255.0, 6)), 0, 255) / 255.0  # digits first: a half is a half on every machine
        steps = 2.0 ** math.ceil(math.log2(max(len(np.unique(whole)), 1)))
        noise = (D.place_poissons(key, whole * steps) / steps - whole) * level
    return np.clip(img + noise, 0, 1)


def add_noise(images: DataFrame, stage: str = "first", seed: int = 0) -> DataFrame:
    """Noise of the drawn kind and level, clipped to [0, 1]: normal, or Poisson in as many steps as the image has values.

    Each place has its own draw, a hash of seed, image, stage and place; gray noise is one draw for all channels.
    """
    def run(img: np.ndarray, image_id: int, draw: dict) -> np.ndarray:
        return _noisy(img, draw[f"{stage}_noise"], draw[f"{stage}_level"], draw[f"{stage}_gray"], D.key32(seed, image_id, stage, "places"))

    return map_images(images, run, params=("image_id", "draw"))


def compress(images: DataFrame, quality: str = "quality") -> DataFrame:
    """Each image (values in [0, 1]) through lossy block compression at its own quality (a column, 1 to 100)."""
    return map_images(images, lambda img, **row: P.jpeg(img, row[quality]), params=(quality,))


def _kernel(draw: dict, stage: str) -> np.ndarray:
    size, kind = draw[f"{stage}_size"], draw[f"{stage}_kernel"]
    if kind == "sinc":
        return P.sinc_kernel(draw[f"{stage}_cutoff"], size)
    return P.blur_kernel(kind, size, draw[f"{stage}_sigma_x"], draw[f"{stage}_sigma_y"], draw[f"{stage}_angle"], draw[f"{stage}_beta"])


def degrade(images: DataFrame, scale: int = 4, seed: int = 0, jpeg_hook: Callable[[np.ndarray, float], np.ndarray] | None = None,
            gt_usm: bool = True) -> DataFrame:
    """Low-quality version of each image (values in [0, 1], with its ``draw``), 1/scale of the size.

    Two rounds of blur, resize, noise and compression, then resize and final filter before or after the last
    compression. ``jpeg_hook(img, quality)`` takes the place of the built-in block compression.
    ``gt_usm`` sharpens the source first.
    """
    jpeg = jpeg_hook or P.jpeg

    def run(img: np.ndarray, image_id: int, draw: dict) -> np.ndarray:
        h, w = img.shape[:2]
        out = P.unsharp(img) if gt_usm else img
        for stage, base in (("first", 1), ("second", scale)):
            if draw[f"{stage}_blur"]:
                out = P.filter2d(out, _kernel(draw, stage))
            factor, mode = draw[f"{stage}_factor"], draw[f"{stage}_mode"]
            shape = (max(int(h / base * factor), 1), max(int(w / base * factor), 1))
            out = P.resize(out, *shape, mode, factor if stage == "first" else None)
            out = _noisy(out, draw[f"{stage}_noise"], draw[f"{stage}_level"], draw[f"{stage}_gray"], D.key32(seed, image_id, stage, "places"))
            if stage == "first":
                out = jpeg(np.clip(out, 0, 1), draw["first_jpeg"])

        def back(pixels: np.ndarray) -> np.ndarray:
            small = P.resize(pixels, h // scale, w // scale, draw["final_mode"])
            return P.filter2d(small, P.sinc_kernel(draw["final_cutoff"], draw["final_size"])) if draw["final_sinc"] else small

        if draw["resize_before_jpeg"]:
            out = jpeg(np.clip(back(out), 0, 1), draw["second_jpeg"])
        else:
            out = back(jpeg(np.clip(out, 0, 1), draw["second_jpeg"]))
        return np.clip((out * 255.0).round(), 0, 255) / 255.0

    return map_images(images, run, params=("image_id", "draw"))


def paired_crop(sides: DataFrame, lq_size: int, seed: int = 0) -> DataFrame:
    """The same random box from both sides of a pair.

    Rows are single images with ``side_scale`` (1 for low quality, the scale for high quality); the box is
    drawn in low-quality pixels from the pair's id, so no join is needed.
    """
    def crop(img: np.ndarray, side_scale: int, top_u: float, left_u: float) -> np.ndarray:
        h, w = (n // side_scale for n in img.shape[:2])
        top, left = int(top_u * (h - lq_size + 1)) * side_scale, int(left_u * (w - lq_size + 1)) * side_scale
        return img[top: top + lq_size * side_scale, left: left + lq_size * side_scale]

    drawn = sides.withColumn("top_u", D.uniform(seed, F.col("image_id"), "crop_top")).withColumn("left_u", D.uniform(seed, F.col("image_id"), "crop_left"))
    return map_images(drawn, crop, ("image_id", "side_scale"), ("side_scale", "top_u", "left_u"))


def augment(images: DataFrame, hflip: bool = True, rotate: bool = True, seed: int = 0, keep: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """Random left-right flip, up-down flip and transposition, the same for all rows of an image id."""
    def turn(img: np.ndarray, flip_x: bool, flip_y: bool, swap: bool) -> np.ndarray:
        img = img[:, ::-1] if flip_x else img
        img = img[::-1] if flip_y else img
        return img.transpose(1, 0, 2) if swap else img

    allowed = {"flip_x": hflip, "flip_y": rotate, "swap": rotate}
    for name, use in allowed.items():
        images = images.withColumn(name, (D.uniform(seed, F.col("image_id"), name) < 0.5) & F.lit(use))
    return map_images(images, turn, keep, tuple(allowed))


def shuffle_pairs(pairs: DataFrame, pool: int, batch: int, seed: int = 0, id: str = "image_id") -> DataFrame:
    """Pairs in random order with their ``position``, ``batch`` and ``pool`` numbers.

    Positions are global but never come from one sort: rows are numbered inside 65536 slices of the draw, and
    only the slice sizes are added up in one place.
    """
    if pool % batch:
        raise ValueError(f"pool size {pool} is not divisible by batch size {batch}")
    drawn = pairs.withColumn("_draw", D.draw32(seed, F.col(id), "order"))
    ranked = ranked_in_group(drawn, [], ["_draw", id], F.shiftright("_draw", 16), "_rank")
    at = F.col("_rank") - 1
    return ranked.withColumn("position", at).withColumn("batch", int_div(at, batch)).withColumn("pool", int_div(at, pool)).drop("_draw", "_rank")


def replace_unreadable(manifest: DataFrame, failures: DataFrame, seed: int = 0) -> DataFrame:
    """Manifest ``(item, path)`` with a random readable path in place of each failed one.

    Picks come only from readable rows, so one try is enough. The manifest is read and marked once (a written table);
    its readable paths are numbered in hash slices, and a replaced row finds its pick by number.
    """
    spark, marked = manifest.sparkSession, scratch_dir(manifest.sparkSession, "manifest")
    failed = failures.select("path").distinct().withColumn("_failed", F.lit(True))
    known = manifest.join(failed, "path", "left").select("item", "path", F.coalesce("_failed", F.lit(False)).alias("replaced"))
    known.write.parquet(marked)
    rows = spark.read.schema(known.schema).parquet(marked)
    hashed = rows.filter(~F.col("replaced") & F.col("path").isNotNull()).select("path").distinct().withColumn("_draw", D.draw32(seed, F.col("path")))
    numbered = ranked_in_group(hashed, [], ["_draw", "path"], F.shiftright("_draw", 16), "_number").select(F.col("path").alias("new_path"), "_number")
    count = hashed.agg(F.count(F.lit(1)).alias("n")).scalar()
    picks = rows.filter("replaced").withColumn("_number", F.floor(D.uniform(seed, F.col("item"), "replace") * count) + 1)
    replaced = picks.join(numbered, "_number", "left").select("item", F.col("new_path").alias("path"), "replaced")
    return rows.filter(~F.col("replaced")).unionByName(replaced)


def pair_images(lq: DataFrame, gt: DataFrame, template: str = "{}", lq_root: str | None = None, gt_root: str | None = None) -> DataFrame:
    """Pairs by file stem: the low-quality stem is ``template`` filled with the high-quality stem.

    With both roots, files are paired inside the same folder below them, so equal names in different folders stay apart;
    without, folders do not matter. A file without its partner keeps a row with an error.
    """
    before, after = template.split("{}")

    def folder(path: str, root: str | None) -> Column:
        if lq_root is None or gt_root is None:
            return F.lit("")
        below = F.when(F.col(path).startswith(f"{root.rstrip('/')}/"), F.substring(F.col(path), F.lit(len(root.rstrip("/")) + 2), F.length(path))).otherwise(F.col(path))
        return F.regexp_replace(below, "[^/]*$", "")

    want = F.concat(F.lit(before), names.stem(F.col("gt_path")), F.lit(after))
    left = gt.select("gt_path", folder("gt_path", gt_root).alias("_folder"), want.alias("_stem"))
    right = lq.select("lq_path", folder("lq_path", lq_root).alias("_folder"), names.stem(F.col("lq_path")).alias("_stem"))
    error = F.when(F.col("lq_path").isNull(), "no low-quality file").when(F.col("gt_path").isNull(), "no high-quality file")
    return left.join(right, ["_folder", "_stem"], "full").select("gt_path", "lq_path", error.alias("error"))


def blend_weights(a: DataFrame, b: DataFrame, w0: float, w1: float) -> DataFrame:
    """``w0 * a + w1 * b`` by tensor name; a name on one side only or of another length stops the job."""
    both = a.select("name", F.col("values").alias("_a")).join(b.select("name", F.col("values").alias("_b")), "name", "full")
    fits = F.coalesce(F.size("_a") == F.size("_b"), F.lit(False)) & F.col("_a").isNotNull() & F.col("_b").isNotNull()
    blended = F.zip_with("_a", "_b", lambda x, y: x.cast("double") * w0 + y.cast("double") * w1)
    return both.select("name", F.when(fits, blended).otherwise(F.raise_error(F.concat(F.lit("weights do not match: "), F.col("name").cast("string")))).alias("values"))
