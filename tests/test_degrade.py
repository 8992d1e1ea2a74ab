"""The whole degradation against a version in plain Python: loops over pixels, whole numbers for hashes, sums of cosines."""

import cmath
import hashlib
import math

import numpy as np
import pytest

from frameline.operators import synth as S

SHAPE = "image_id long, h int, w int, c int, data array<double>"
LIGHT = [[16, 11, 10, 16, 24, 40, 51, 61], [12, 12, 14, 19, 26, 58, 60, 55], [14, 13, 16, 24, 40, 57, 69, 56], [14, 17, 22, 29, 51, 87, 80, 62],
         [18, 22, 37, 56, 68, 109, 103, 77], [24, 35, 55, 64, 81, 104, 113, 92], [49, 64, 78, 87, 103, 121, 120, 101], [72, 92, 95, 98, 112, 100, 103, 99]]
COLOUR = [[{(0, 0): 17, (0, 1): 18, (0, 2): 24, (0, 3): 47, (1, 1): 21, (1, 2): 26, (1, 3): 66, (2, 2): 56}.get((min(i, j), max(i, j)), 99) for j in range(8)] for i in range(8)]


def mirrored(i, n):
    if n == 1:
        return 0
    i %= 2 * (n - 1)
    return i if i < n else 2 * (n - 1) - i


def plane_filter(a, kernel):
    h, w, half = len(a), len(a[0]), len(kernel) // 2
    return [[sum(kernel[i][j] * a[mirrored(y + i - half, h)][mirrored(x + j - half, w)] for i in range(len(kernel)) for j in range(len(kernel))) for x in range(w)] for y in range(h)]


def unsharp(a):
    line = [math.exp(-((k - 25) ** 2) / (2 * 8.0**2)) for k in range(51)]
    line = [v / sum(line) for v in line]

    def blur(p):
        h, w = len(p), len(p[0])
        rows = [[sum(line[k] * p[y][mirrored(x + k - 25, w)] for k in range(51)) for x in range(w)] for y in range(h)]
        return [[sum(line[k] * rows[mirrored(y + k - 25, h)][x] for k in range(51)) for x in range(w)] for y in range(h)]

    detail = [[v - b for v, b in zip(r, s)] for r, s in zip(a, blur(a))]
    soft = blur([[float(abs(d) * 255 > 10) for d in r] for r in detail])
    return [[m * min(max(v + 0.5 * d, 0), 1) + (1 - m) * v for v, d, m in zip(*rows)] for rows in zip(a, detail, soft)]


def bessel(x, n=500):
    """First-order Bessel function by its integral (trapezoid rule over a whole period)."""
    return sum(math.cos(2 * math.pi * k / n - x * math.sin(2 * math.pi * k / n)) for k in range(n)) / n


def kernel(draw, stage):
    n, kind = draw[f"{stage}_size"], "sinc" if stage == "final" else draw[f"{stage}_kernel"]
    out = []
    for i in range(n):
        for j in range(n):
            y, x = i - n // 2, j - n // 2
            if kind == "sinc":
                w, r = draw[f"{stage}_cutoff"], math.hypot(x, y)
                out.append(w * w / (4 * math.pi) if r == 0 else w * bessel(w * r) / (2 * math.pi * r))
                continue
            sx, sy, beta = draw[f"{stage}_sigma_x"], draw[f"{stage}_sigma_y"], draw[f"{stage}_beta"]
            if kind.endswith("aniso"):
                turned = complex(x, y) * cmath.exp(-1j * draw[f"{stage}_angle"])
                q = (turned.real / sx) ** 2 + (turned.imag / sy) ** 2
            else:
                q = (x * x + y * y) / sx**2
            out.append(1 / (q**beta + 1) if kind.startswith("plateau") else math.exp(-0.5 * q ** (beta if kind.startswith("generalized") else 1)))
    return [[v / sum(out) for v in out[i * n : (i + 1) * n]] for i in range(n)]


def line_weights(n, m, mode, step):
    """For each of m places the (source, weight) pairs."""
    out = []
    for i in range(m):
        if mode == "area":
            first, last = i * n // m, -(-(i + 1) * n // m)
            out.append([(k, 1 / (last - first)) for k in range(first, last)])
            continue
        p = (i + 0.5) * step - 0.5
        if mode == "bilinear":
            p = max(p, 0.0)
            taps = [(math.floor(p), 1 - (p - math.floor(p))), (math.floor(p) + 1, p - math.floor(p))]
        else:
            taps = []
            for k in range(-1, 3):
                d = abs(p - math.floor(p) - k)
                taps.append((math.floor(p) + k, 1.25 * d**3 - 2.25 * d**2 + 1 if d <= 1 else -0.75 * (d**3 - 5 * d**2 + 8 * d - 4)))
        out.append([(min(max(k, 0), n - 1), v) for k, v in taps])
    return out


def resized(a, h, w, mode, factor=None):
    down = line_weights(len(a), h, mode, 1 / factor if factor else len(a) / h)
    across = line_weights(len(a[0]), w, mode, 1 / factor if factor else len(a[0]) / w)
    return [[sum(u * v * a[y][x] for y, u in ys for x, v in xs) for xs in across] for ys in down]


def mixed(x):
    x ^= x >> 16
    x = x * 2246822507 % 2**32
    x ^= x >> 13
    x = x * 3266489909 % 2**32
    return x ^ x >> 16


def noisy(planes, draw, stage, image_id):
    key = int(hashlib.md5(f"0/{image_id}/{stage}/places".encode()).hexdigest()[:8], 16)
    kind, level = draw[f"{stage}_noise"], draw[f"{stage}_level"]
    h, w, gray = len(planes[0]), len(planes[0][0]), draw[f"{stage}_gray"] and len(planes) == 3
    source = [[[sum(g * p[y][x] for g, p in zip((0.2989, 0.587, 0.114), planes)) for x in range(w)] for y in range(h)]] if gray else planes

    def uniform(place, stream):
        return (mixed(mixed((place * 2 + stream) * 2654435769 % 2**32) ^ key) + 0.5) / 2**32

    whole = [[[min(max(round(round(v * 255, 6)), 0), 255) / 255 for v in r] for r in p] for p in source]
    steps = 2 ** math.ceil(math.log2(len({v for p in whole for r in p for v in r})))
    noise = []
    for c in range(len(source)):
        noise.append([[0.0] * w for _ in range(h)])
        for y in range(h):
            for x in range(w):
                place = (y * w + x) * len(source) + c
                if kind == "gaussian":
                    value = math.sqrt(-2 * math.log(uniform(place, 0))) * math.cos(2 * math.pi * uniform(place, 1)) * level / 255
                else:
                    mean, k, chance = whole[c][y][x] * steps, 0, math.exp(-whole[c][y][x] * steps)
                    upto = chance
                    while upto < uniform(place, 0) and mean > 0:
                        k += 1
                        chance *= mean / k
                        upto += chance
                    value = (k / steps - whole[c][y][x]) * level
                noise[c][y][x] = value
    return [[[min(max(v + noise[0 if gray else c][y][x], 0), 1) for x, v in enumerate(r)] for y, r in enumerate(p)] for c, p in enumerate(planes)]


def blocks(plane, table, factor):
    """A plane (sides divisible by 8) through its quantised cosine transform."""
    wave = [[math.cos((2 * x + 1) * k * math.pi / 16) * math.sqrt((1 if k == 0 else 2) / 8) for x in range(8)] for k in range(8)]
    out = [[0.0] * len(plane[0]) for _ in plane]
    for top in range(0, len(plane), 8):
        for left in range(0, len(plane[0]), 8):
            kept = {}
            for a in range(8):
                for b in range(8):
                    found = sum(wave[a][y] * wave[b][x] * (plane[top + y][left + x] - 128) for y in range(8) for x in range(8))
                    step = table[b][a] * factor
                    kept[a, b] = round(round(found, 6) / step) * step
            for y in range(8):
                for x in range(8):
                    out[top + y][left + x] = sum(wave[a][y] * wave[b][x] * v for (a, b), v in kept.items()) + 128
    return out


def compressed(planes, quality):
    h, w, factor = len(planes[0]), len(planes[0][0]), (5000 / quality if quality < 50 else 200 - 2 * quality) / 100
    tall, wide = h + -h % 16, w + -w % 16
    full = [[[p[y][x] * 255 if y < h and x < w else 0.0 for x in range(wide)] for y in range(tall)] for p in planes]
    if len(planes) == 1:
        back = [blocks(full[0], LIGHT, factor)]
    else:
        r, g, b = full
        light = [[0.299 * r[y][x] + 0.587 * g[y][x] + 0.114 * b[y][x] for x in range(wide)] for y in range(tall)]
        blue = [[-0.168736 * r[y][x] - 0.331264 * g[y][x] + 0.5 * b[y][x] for x in range(wide)] for y in range(tall)]
        red = [[0.5 * r[y][x] - 0.418688 * g[y][x] - 0.081312 * b[y][x] for x in range(wide)] for y in range(tall)]
        half = [[[sum(p[2 * y + i][2 * x + j] for i in (0, 1) for j in (0, 1)) / 4 + 128 for x in range(wide // 2)] for y in range(tall // 2)] for p in (blue, red)]
        light, (blue, red) = blocks(light, LIGHT, factor), [blocks(p, COLOUR, factor) for p in half]
        back = [[[0.0] * wide for _ in range(tall)] for _ in range(3)]
        for y in range(tall):
            for x in range(wide):
                u, v = blue[y // 2][x // 2] - 128, red[y // 2][x // 2] - 128
                back[0][y][x], back[1][y][x], back[2][y][x] = light[y][x] + 1.402 * v, light[y][x] - 0.344136 * u - 0.714136 * v, light[y][x] + 1.772 * u
    return [[[min(max(p[y][x], 0), 255) / 255 for x in range(w)] for y in range(h)] for p in back]


def degraded(img, draw, image_id, gt_usm, scale=4):
    h, w, c = img.shape
    planes = [img[..., i].tolist() for i in range(c)]
    out = [unsharp(p) for p in planes] if gt_usm else planes
    for stage, base in (("first", 1), ("second", scale)):
        if draw[f"{stage}_blur"]:
            out = [plane_filter(p, kernel(draw, stage)) for p in out]
        factor = draw[f"{stage}_factor"]
        size = max(int(h / base * factor), 1), max(int(w / base * factor), 1)
        out = [resized(p, *size, draw[f"{stage}_mode"], factor if stage == "first" else None) for p in out]
        out = noisy(out, draw, stage, image_id)
        if stage == "first":
            out = compressed(out, draw["first_jpeg"])

    def back(ps):
        small = [resized(p, h // scale, w // scale, draw["final_mode"]) for p in ps]
        return [plane_filter(p, kernel(draw, "final")) for p in small] if draw["final_sinc"] else small

    def clipped(ps):
        return [[[min(max(v, 0), 1) for v in r] for r in p] for p in ps]

    out = compressed(clipped(back(out)), draw["second_jpeg"]) if draw["resize_before_jpeg"] else back(compressed(clipped(out), draw["second_jpeg"]))
    return np.array([[[min(max(round(v * 255), 0), 255) / 255 for v in r] for r in p] for p in out]).transpose(1, 2, 0)


@pytest.mark.parametrize("gt_usm", [True, False])
def test_degradation_equals_plain_loops(spark, gt_usm):
    """Gray and colour images of several sizes, with enough draws for every branch."""
    rng = np.random.default_rng(17)
    images = [rng.random((16, 16 + 4 * (i % 3), 3 if i % 4 == 0 else 1)) for i in range(16)]
    rows = [(i, *a.shape, a.ravel().tolist()) for i, a in enumerate(images)]
    drawn = S.draw_params(spark.createDataFrame(rows, SHAPE))
    draws = {r.image_id: r.draw.asDict() for r in drawn.select("image_id", "draw").collect()}
    got = {r.image_id: np.array(r.data).reshape(r.h, r.w, r.c) for r in S.degrade(drawn, gt_usm=gt_usm).collect()}
    for name, seen in (("first_noise", 2), ("second_noise", 2), ("first_mode", 3), ("resize_before_jpeg", 2), ("final_sinc", 2), ("second_blur", 2), ("first_resize", 3)):
        assert len({d[name] for d in draws.values()}) == seen, name
    for i, img in enumerate(images):
        want = degraded(img, draws[i], i, gt_usm)
        assert got[i].shape == want.shape and np.abs(got[i] - want).max() < 1e-9, (i, draws[i])
