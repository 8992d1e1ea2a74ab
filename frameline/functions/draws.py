"""Repeatable random draws from a seed and names, equal on every run and engine."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def draw32(seed: int | str, *parts: Column | str) -> Column:
    """Whole number in [0, 2^32) from the MD5 of ``seed/part/part...``."""
    text = F.concat_ws("/", F.lit(str(seed)), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def uniform(seed: int | str, *parts: Column | str) -> Column:
    """Double in [0, 1)."""
    return draw32(seed, *parts) / F.lit(4294967296.0)


def between(u: Column, low: float | Column, high: float | Column) -> Column:
    low = F.lit(float(low)) if isinstance(low, (int, float)) else low
    high = F.lit(float(high)) if isinstance(high, (int, float)) else high
    return low + u * (high - low)


def choice(u: Column, names: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    """Name picked by cumulative weight; equal weights when none are given."""
    weights = [1.0] * len(names) if weights is None else weights
    total, upto, out = sum(weights), 0.0, None
    for name, weight in list(zip(names, weights))[:-1]:
        upto += weight
        hit = u < round(upto / total, 12)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(names[-1]) if out is None else out.otherwise(names[-1])


# Draws at the places of an image --------------------------------------------------------------------------------------
# There is no generator with a state: the number at a place is a hash of key and place, so it does not matter in which
# order, batch or task the places are visited.

# Multipliers of the 32-bit finaliser and the step between counters.
MIX_1, MIX_2, STEP = 2246822507, 3266489909, 2654435769
WORD = 0xFFFFFFFF


def key32(seed: int | str, *parts: object) -> int:
    """The number of :func:`draw32` for plain values."""
    return int(hashlib.md5("/".join(map(str, (seed, *parts))).encode()).hexdigest()[:8], 16)


def mix32(x: np.ndarray) -> np.ndarray:
    """A permutation of 32-bit numbers in which every bit depends on every bit."""
    x = x ^ (x >> np.uint64(16))
    x = (x * np.uint64(MIX_1)) & np.uint64(WORD)
    x = x ^ (x >> np.uint64(13))
    x = (x * np.uint64(MIX_2)) & np.uint64(WORD)
    return x ^ (x >> np.uint64(16))


def place_uniforms(key: int, count: int, stream: int) -> np.ndarray:
    """Doubles inside (0, 1), one for each of the places 0, 1, ...; streams are independent of each other."""
    places = np.arange(count, dtype=np.uint64) * np.uint64(2) + np.uint64(stream)
    counter = (places * np.uint64(STEP)) & np.uint64(WORD)
    return (mix32(mix32(counter) ^ np.uint64(key)).astype(float) + 0.5) / (WORD + 1.0)


def place_normals(key: int, count: int) -> np.ndarray:
    """Standard normal values by the polar form of two uniforms."""
    return np.sqrt(-2.0 * np.log(place_uniforms(key, count, 0))) * np.cos(2.0 * math.pi * place_uniforms(key, count, 1))


def place_poissons(key: int, means: np.ndarray) -> np.ndarray:
    """Poisson values with the given means (256 at most) by inversion: the first count whose cumulative chance reaches a uniform."""
    drawn, out = place_uniforms(key, means.size, 0), np.zeros(means.size)
    flat, where = np.unique(means.ravel(), return_inverse=True)
    for i, mean in enumerate(flat):
        if mean > 0:
            counts = np.arange(1, int(mean + 16 * math.sqrt(mean) + 32))
            upto = np.cumsum(np.concatenate([[math.exp(-mean)], math.exp(-mean) * np.cumprod(mean / counts)]))
            at = where.ravel() == i
            out[at] = np.searchsorted(upto, drawn[at])
    return out.reshape(means.shape)
