"""Column functions for frame rates, batch sizes, resources and capacity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# More than this many frames -> frames per batch.
FRAME_TIERS = ((1000, 20), (500, 15), (200, 10))
SMALLEST_BATCH = 5

# More than this host memory (MB) -> images per batch.
MEMORY_TIERS = ((30000, 4), (15000, 2))
CPU_BATCH = 4
IMAGE_MB = 500
LARGEST_BATCH = 16

# Tile edge for images with a side longer than the limit.
AUTO_TILE_SIDE = 1500
AUTO_TILE = 1024


def _tiers(value: Column, tiers, rest: int) -> Column:
    out = None
    for limit, size in tiers:
        out = F.when(value > limit, size) if out is None else out.when(value > limit, size)
    return out.otherwise(rest)


def clamp(value: Column, low, high) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def int_div(a: Column, b: Column | int) -> Column:
    """Whole-number division."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def frame_rate(text: Column) -> Column:
    """``num/den`` cut (not rounded) to two digits; null when the denominator is zero or a part is no number."""
    parts = F.split(text, "/")
    num, den = F.get(parts, F.lit(0)).try_cast("long"), F.when(F.size(parts) < 2, F.lit(1).cast("long")).otherwise(F.get(parts, F.lit(1)).try_cast("long"))
    hundredths = F.floor(num * 100 / F.nullif(den, F.lit(0)))
    return (hundredths / 100.0).cast("double")


def batch_size_by_frames(frames: Column) -> Column:
    return _tiers(frames, FRAME_TIERS, SMALLEST_BATCH)


def batch_size_by_host_memory(memory_mb: Column) -> Column:
    return _tiers(memory_mb, MEMORY_TIERS, 1)


def batch_size_by_gpu_memory(free_mb: Column) -> Column:
    """Images that fit in 80 % of the free memory, between 1 and 16; 4 without a GPU (null)."""
    fit = F.floor(free_mb * F.lit(0.8).cast("double") / IMAGE_MB)
    return F.when(free_mb.isNull(), F.lit(CPU_BATCH)).otherwise(clamp(fit, 1, LARGEST_BATCH)).cast("int")


def choose_tile(height: Column, width: Column, asked: Column | None = None) -> Column:
    asked = F.lit(0) if asked is None else F.coalesce(asked, F.lit(0))
    return F.when((asked == 0) & (F.greatest(height, width) > AUTO_TILE_SIDE), AUTO_TILE).otherwise(asked)
