"""NumPy helpers on one image of shape (h, w, c). Everything that moves or groups rows is done by Spark."""

from __future__ import annotations

import functools
import math

import numpy as np

DIRECT_TAPS = 64
# Quantisation steps of lightness and of colour at quality 50. The recipe reads them by columns.
LIGHT_STEPS = (
    (16, 11, 10, 16, 24, 40, 51, 61),
    (12, 12, 14, 19, 26, 58, 60, 55),
    (14, 13, 16, 24, 40, 57, 69, 56),
    (14, 17, 22, 29, 51, 87, 80, 62),
    (18, 22, 37, 56, 68, 109, 103, 77),
    (24, 35, 55, 64, 81, 104, 113, 92),
    (49, 64, 78, 87, 103, 121, 120, 101),
    (72, 92, 95, 98, 112, 100, 103, 99),
)
COLOUR_STEPS = ((17, 18, 24, 47), (18, 21, 26, 66), (24, 26, 56, 99), (47, 66, 99, 99))
COARSEST_STEP = 99
# Lightness and the two colour differences of an RGB pixel, and the way back.
TO_LIGHT = ((0.299, 0.587, 0.114), (-0.168736, -0.331264, 0.5), (0.5, -0.418688, -0.081312))
FROM_LIGHT = ((1.0, 0.0, 1.402), (1.0, -0.344136, -0.714136), (1.0, 1.772, 0.0))
MIDDLE = 128.0
COEFFICIENT_DIGITS = 6


def pad_bottom_right(img: np.ndarray, down: int, right: int, mode: str) -> np.ndarray:
    return np.pad(img, ((0, down), (0, right), (0, 0)), mode=mode) if down or right else img


def pad_reflect(img: np.ndarray, pre_pad: int, multiple: int | None) -> np.ndarray:
    """Fixed pad, then up to a multiple; the edge itself is not repeated."""
    img = pad_bottom_right(img, pre_pad, pre_pad, "reflect")
    if multiple:
        img = pad_bottom_right(img, -img.shape[0] % multiple, -img.shape[1] % multiple, "reflect")
    return img


def pad_flip(img: np.ndarray, window: int) -> np.ndarray:
    """Up to the next multiple, a full window more when already divisible; the edge is repeated."""
    down, right = ((n // window + 1) * window - n for n in img.shape[:2])
    return pad_bottom_right(img, down, right, "symmetric")


def depth_to_space(img: np.ndarray, r: int) -> np.ndarray:
    h, w, c = img.shape
    return img.reshape(h, w, c // (r * r), r, r).transpose(0, 3, 1, 4, 2).reshape(h * r, w * r, c // (r * r))


def space_to_depth(img: np.ndarray) -> np.ndarray:
    """Factor 2, sub-images in the order even/even, odd row, odd column, odd/odd."""
    return np.concatenate([img[dy::2, dx::2] for dx in (0, 1) for dy in (0, 1)], axis=2)


def upsample_nearest(img: np.ndarray, s: int) -> np.ndarray:
    return img.repeat(s, axis=0).repeat(s, axis=1)


def _taps(positions: np.ndarray, weights: np.ndarray, n_in: int) -> np.ndarray:
    """Weight matrix (out, in) from tap positions and weights; positions outside are moved to the border."""
    matrix = np.zeros((positions.shape[0], n_in))
    rows = np.repeat(np.arange(positions.shape[0]), positions.shape[1])
    np.add.at(matrix, (rows, np.clip(positions, 0, n_in - 1).ravel()), weights.ravel())
    return matrix


def resize_weights(n_in: int, n_out: int, mode: str, factor: float | None = None) -> np.ndarray:
    """Separable resize as a matrix (out, in): area, nearest, bilinear, bicubic (a = -0.75) or lanczos4.

    Sample centres are half-pixel. ``factor`` replaces the size ratio in the coordinate map.
    """
    step = n_in / n_out if factor is None else 1.0 / factor
    i = np.arange(n_out)
    if mode == "area":
        first, last = (i * n_in) // n_out, -((-(i + 1) * n_in) // n_out)
        inside = (np.arange(n_in) >= first[:, None]) & (np.arange(n_in) < last[:, None])
        return inside / (last - first)[:, None]
    centre = (i + 0.5) * step - 0.5
    if mode == "nearest":
        return _taps(np.floor(i * step).astype(int)[:, None], np.ones((n_out, 1)), n_in)
    if mode == "bilinear":
        centre = np.maximum(centre, 0.0)
        base = np.floor(centre).astype(int)
        t = centre - base
        return _taps(np.stack([base, base + 1], 1), np.stack([1 - t, t], 1), n_in)
    base = np.floor(centre).astype(int)
    if mode == "bicubic":
        offsets = np.arange(-1, 3)
        d, a = np.abs((centre - base)[:, None] - offsets), -0.75
        weights = np.where(d <= 1, ((a + 2) * d - (a + 3)) * d * d + 1, ((d - 5) * d + 8) * d * a - 4 * a)
    elif mode == "lanczos4":
        offsets = np.arange(-3, 5)
        d = (centre - base)[:, None] - offsets
        weights = np.sinc(d) * np.sinc(d / 4)
        weights /= weights.sum(axis=1, keepdims=True)
    else:
        raise ValueError(f"unknown resize mode {mode}")
    return _taps(base[:, None] + offsets, weights, n_in)


def resize(img: np.ndarray, h: int, w: int, mode: str, factor: float | None = None) -> np.ndarray:
    down = resize_weights(img.shape[0], h, mode, factor)
    across = resize_weights(img.shape[1], w, mode, factor)
    return np.einsum("yi,ijc,xj->yxc", down, img, across, optimize=True)


def filter2d(img: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Correlation with a square odd kernel, borders reflected; wide kernels go through the Fourier transform."""
    half, (h, w, _) = kernel.shape[0] // 2, img.shape
    padded = np.pad(img, ((half, half), (half, half), (0, 0)), mode="reflect")
    taps = list(zip(*np.nonzero(kernel)))
    if len(taps) > DIRECT_TAPS:
        size = padded.shape[:2]
        spectrum = np.fft.rfft2(padded, axes=(0, 1)) * np.conj(np.fft.rfft2(kernel, s=size))[:, :, None]
        return np.fft.irfft2(spectrum, s=size, axes=(0, 1))[:h, :w]
    out = np.zeros(img.shape, dtype=np.result_type(img, kernel))
    for dy, dx in taps:
        out += kernel[dy, dx] * padded[dy:dy + h, dx:dx + w]
    return out


def gaussian_1d(size: int) -> np.ndarray:
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    x = np.arange(size) - (size - 1) / 2
    g = np.exp(-(x * x) / (2 * sigma * sigma))
    return g / g.sum()


@functools.lru_cache(maxsize=16)
def blur_matrix(n: int, size: int) -> np.ndarray:
    """Gaussian blur of ``n`` samples as a matrix, borders reflected."""
    index = np.pad(np.arange(n), size // 2, mode="reflect")
    positions = index[np.arange(n)[:, None] + np.arange(size)]
    return _taps(positions, np.broadcast_to(gaussian_1d(size), positions.shape), n)


def unsharp(img: np.ndarray, weight: float = 0.5, radius: int = 50, threshold: float = 10.0) -> np.ndarray:
    """Unsharp masking: details above the threshold are amplified, blended by a soft mask."""
    size = radius + 1 - radius % 2
    down, across = blur_matrix(img.shape[0], size), blur_matrix(img.shape[1], size)

    def blur(a: np.ndarray) -> np.ndarray:
        return np.einsum("yi,ijc,xj->yxc", down, a, across, optimize=True)

    detail = img - blur(img)
    soft = blur((np.abs(detail) * 255 > threshold).astype(float))
    return soft * np.clip(img + weight * detail, 0, 1) + (1 - soft) * img


def bessel_j1(x: np.ndarray) -> np.ndarray:
    """First-order Bessel function by the midpoint rule on its integral (exact to rounding for these sizes)."""
    n = 128
    tau = (np.arange(n) + 0.5) * math.pi / n
    values, where = np.unique(np.asarray(x, dtype=float), return_inverse=True)
    return np.cos(tau - values[:, None] * np.sin(tau)).mean(axis=-1)[where].reshape(np.shape(x))


def _grid(size: int) -> tuple[np.ndarray, np.ndarray]:
    axis = np.arange(size) - size // 2
    return np.meshgrid(axis, axis)


def sinc_kernel(cutoff: float, size: int) -> np.ndarray:
    """Circular low-pass kernel with the given cut-off frequency."""
    xx, yy = _grid(size)
    r = np.hypot(xx, yy)
    safe = np.where(r == 0, 1.0, r)
    k = np.where(r == 0, cutoff ** 2 / (4 * math.pi), cutoff * bessel_j1(cutoff * safe) / (2 * math.pi * safe))
    return k / k.sum()


def blur_kernel(kind: str, size: int, sigma_x: float, sigma_y: float, angle: float, beta: float) -> np.ndarray:
    """Gaussian, generalized Gaussian or plateau kernel, isotropic or rotated."""
    xx, yy = _grid(size)
    if kind.endswith("aniso"):
        c, s = math.cos(angle), math.sin(angle)
        u, v = (c * xx + s * yy) / sigma_x, (-s * xx + c * yy) / sigma_y
    else:
        u, v = xx / sigma_x, yy / sigma_x
    q = u * u + v * v
    if kind.startswith("plateau"):
        k = 1.0 / (q ** beta + 1)
    else:
        k = np.exp(-0.5 * q ** (beta if kind.startswith("generalized") else 1.0))
    return k / k.sum()


def centred(kernel: np.ndarray, size: int = 21) -> np.ndarray:
    return np.pad(kernel, (size - kernel.shape[0]) // 2)


def pulse(size: int = 21) -> np.ndarray:
    return centred(np.ones((1, 1)), size)


def jpeg_factor(quality: float) -> float:
    """What the quantisation steps are multiplied by at a quality from 1 to 100."""
    return (5000.0 / quality if quality < 50 else 200.0 - 2.0 * quality) / 100.0


def _cosines(n: int = 8) -> np.ndarray:
    """Orthonormal cosine transform as a matrix (frequency, place)."""
    k, x = np.arange(n)[:, None], np.arange(n)
    return np.cos((2 * x + 1) * k * math.pi / (2 * n)) * np.where(k == 0, math.sqrt(1 / n), math.sqrt(2 / n))


def quantised_blocks(plane: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """A plane (sides divisible by 8) through the cosine transform of its 8x8 blocks, quantisation and back.

    Coefficients are cut to a few digits first, so that rounding at a half does not depend on the order of a sum. A step
    of 0 (quality 100) leaves the coefficient as it is.
    """
    (h, w), basis = plane.shape, _cosines()
    blocks = plane.reshape(h // 8, 8, w // 8, 8).transpose(0, 2, 1, 3) - MIDDLE
    found = np.round(basis @ blocks @ basis.T, COEFFICIENT_DIGITS)
    safe = np.where(steps > 0, steps, 1.0)
    kept = np.where(steps > 0, np.round(found / safe) * steps, found)
    return (basis.T @ kept @ basis + MIDDLE).transpose(0, 2, 1, 3).reshape(h, w)


def jpeg(img: np.ndarray, quality: float) -> np.ndarray:
    """What lossy block compression does to an image with values in [0, 1].

    Of three channels (RGB) lightness and colour are parted and colour is averaged over 2x2 pixels; of any other number
    each is lightness. Every 8x8 block is quantised in its cosine transform, and all of it is undone. Sides are padded
    with 0 to a multiple of 16 and cut again. There is no entropy coding: nothing is stored.
    """
    h, w, channels = img.shape
    factor = jpeg_factor(quality)
    light = np.array(LIGHT_STEPS, dtype=float).T * factor
    planes = np.pad(img * 255.0, ((0, -h % 16), (0, -w % 16), (0, 0)))
    if channels != 3:
        out = np.stack([quantised_blocks(planes[..., i], light) for i in range(channels)], axis=-1)
    else:
        colour = np.full((8, 8), float(COARSEST_STEP))
        colour[:4, :4] = np.array(COLOUR_STEPS, dtype=float).T
        planes = planes @ np.array(TO_LIGHT).T
        small = planes[..., 1:].reshape(planes.shape[0] // 2, 2, planes.shape[1] // 2, 2, 2).mean(axis=(1, 3)) + MIDDLE
        back = [quantised_blocks(small[..., i], colour * factor).repeat(2, axis=0).repeat(2, axis=1) - MIDDLE for i in (0, 1)]
        out = np.stack([quantised_blocks(planes[..., 0], light), *back], axis=-1) @ np.array(FROM_LIGHT).T
    return np.clip(out[:h, :w], 0, 255) / 255.0
