"""Queries over image tables, compared pixel by pixel."""

from pyspark.sql import functions as F

from frameline.fixtures import cte
from frameline.operators import images as M
from frameline.operators.image_rows import to_pixels
from frameline.operators.infer import nearest_predict
from frameline.plans.upscale import upscale
from frameline.registry import query


def rounded(df, digits=6):
    return df.withColumn("v", F.round("v", digits))


def rounded_off_ties(df):
    """Resampled values are often exact halves of the last digit, which rounding noise would decide."""
    return df.withColumn("v", F.round(F.col("v") + F.lit(1e-9), 6))


def gather(base: str, height: str, width: str, y: str, x: str, c: str = "0", channels: str = "1", v: str = "s.v") -> str:
    """SQL: every target pixel takes the source pixel at (y, x, c), given as formulas over target ty, tx, tc."""
    return f"""t AS (SELECT image_id, cast(ty AS int) AS y, cast(tx AS int) AS x, cast(tc AS int) AS c, {y} AS sy, {x} AS sx, {c} AS sc
 FROM (SELECT DISTINCT image_id FROM {base}) i, range(0, {height}) a(ty), range(0, {width}) b(tx), range(0, {channels}) d(tc))
SELECT t.image_id, t.y, t.x, t.c, {v} AS v FROM t JOIN {base} s ON s.image_id = t.image_id AND s.y = t.sy AND s.x = t.sx AND s.c = t.sc"""


DEEP = "SELECT image_id, y, x, c, CASE WHEN image_id % 2 = 0 THEN v * 257 ELSE v END AS v FROM pixels"


def deep(t):
    return t.images().withColumn("data", F.when(F.col("image_id") % 2 == 0, F.transform("data", lambda v: v * 257)).otherwise(F.col("data")))


@query("normalize_range", "I01", f"""{cte('pixels', deep=DEEP)}, m AS (SELECT image_id, CASE WHEN max(v) > 256 THEN 65535 ELSE 255 END AS max_range FROM deep GROUP BY 1)
SELECT d.image_id, max_range, y, x, c, round(v / max_range, 6) AS v FROM deep d JOIN m ON m.image_id = d.image_id""")
def _(t):
    return rounded(to_pixels(M.normalize_range(deep(t)), "max_range"))


@query("quantize", "I09 D07", f"{cte('pixels')} SELECT image_id, y, x, c, round_even(greatest(0, least(1, v / 200 - 0.1::double)) * 255, 0) AS v FROM pixels")
def _(t):
    spread = t.images().withColumn("data", F.transform("data", lambda v: v / 200 - F.lit(0.1))).withColumn("max_range", F.lit(255))
    return to_pixels(M.quantize(spread))


@query("split_mode", "I02", f"""{cte('pixels', 'bgra')} SELECT image_id, 'L' AS mode, 'color' AS part, y, x, cast(k AS int) AS c, v FROM pixels, range(0, 3) r(k)
UNION ALL SELECT image_id + 1000000, 'RGBA', 'color', y, x, 2 - c, v FROM bgra WHERE c < 3 UNION ALL SELECT image_id + 1000000, 'RGBA', 'alpha', y, x, 0, v FROM bgra WHERE c = 3""")
def _(t):
    both = t.images().unionByName(t.images("bgra").withColumn("image_id", F.col("image_id") + 1000000))
    return to_pixels(M.split_mode(both), "mode", "part")


@query("pad_reflect", "I03", f"{cte('pixels')}, {gather('pixels', '12', '12', 'CASE WHEN ty >= 11 THEN 5 WHEN ty >= 8 THEN 14 - ty ELSE ty END', 'CASE WHEN tx >= 11 THEN 5 WHEN tx >= 8 THEN 14 - tx ELSE tx END')}")
def _(t):
    return to_pixels(M.pad_reflect(t.images(), 3, 4))


@query("pad_flip", "I04", f"{cte('pixels')}, {gather('pixels', '16', '16', 'CASE WHEN ty >= 8 THEN 15 - ty ELSE ty END', 'CASE WHEN tx >= 8 THEN 15 - tx ELSE tx END')}")
def _(t):
    return to_pixels(M.pad_flip(t.images(), 8))


GRID = """g AS (SELECT image_id, 8 AS h, 8 AS w, 1 AS c, cast(ty AS int) AS ty, cast(tx AS int) AS tx, cast(ty * 3 + tx + 1 AS int) AS tile_id, cast(ty * 3 AS int) AS y0, cast(least(ty * 3 + 3, 8) AS int) AS y1, cast(tx * 3 AS int) AS x0, cast(least(tx * 3 + 3, 8) AS int) AS x1
 FROM (SELECT DISTINCT vec_id AS image_id FROM embeddings) i, range(0, 3) a(ty), range(0, 3) b(tx)),
grid AS (SELECT *, greatest(y0 - 1, 0) AS pad_y0, least(y1 + 1, 8) AS pad_y1, greatest(x0 - 1, 0) AS pad_x0, least(x1 + 1, 8) AS pad_x1, y0 * 2 AS out_y0, y1 * 2 AS out_y1, x0 * 2 AS out_x0, x1 * 2 AS out_x1 FROM g)"""


@query("tile_grid", "I05", f"WITH {GRID} SELECT * FROM grid")
def _(t):
    return M.tile_grid(t.images(), 3, 1, 2)


@query("tile_pixels", "J16", f"{cte('pixels')}, {GRID} SELECT g.image_id, tile_id, p.y, p.x, p.c, p.v FROM grid g JOIN pixels p ON p.image_id = g.image_id AND p.y >= pad_y0 AND p.y < pad_y1 AND p.x >= pad_x0 AND p.x < pad_x1")
def _(t):
    return M.tile_pixels(to_pixels(t.images()), t.images(), 3, 1)


@query("cut_tiles", "I06", f"{cte('pixels')}, {GRID} SELECT g.image_id, tile_id, p.y - pad_y0 AS y, p.x - pad_x0 AS x, p.c, p.v FROM grid g JOIN pixels p ON p.image_id = g.image_id AND p.y >= pad_y0 AND p.y < pad_y1 AND p.x >= pad_x0 AND p.x < pad_x1")
def _(t):
    return to_pixels(M.cut_tiles(t.images(), 3, 1), "tile_id")


DOUBLED = gather('pixels', '16', '16', 'ty // 2', 'tx // 2')


@query("merge_tiles", "I07", f"{cte('pixels')}, merged AS (WITH {DOUBLED}) SELECT image_id, CASE WHEN image_id % 4 = 0 THEN 1 ELSE 0 END AS missing, y, x, c, CASE WHEN image_id % 4 = 0 AND y >= 6 AND y < 12 AND x >= 12 THEN 0 ELSE v END AS v FROM merged")
def _(t):
    images = t.images()
    tiles = M.upsample_nearest(M.cut_tiles(images, 3, 1), 2, ("image_id", "tile_id"))
    kept = tiles.filter("NOT (image_id % 4 = 0 AND tile_id = 6)")
    return to_pixels(M.merge_tiles(kept, images, 3, 1, 2), "missing")


@query("merge_stripes", "I07", f"""{cte('pixels')}, merged AS (WITH {DOUBLED}) SELECT image_id, cast(y // 5 AS int) AS stripe, CASE WHEN image_id % 4 = 0 AND y // 5 IN (1, 2) THEN 1 ELSE 0 END AS missing, y, x, c,
CASE WHEN image_id % 4 = 0 AND y >= 6 AND y < 12 AND x >= 12 THEN 0 ELSE v END AS v FROM merged""")
def _(t):
    images = t.images()
    tiles = M.upsample_nearest(M.cut_tiles(images, 3, 1), 2, ("image_id", "tile_id"))
    kept = tiles.filter("NOT (image_id % 4 = 0 AND tile_id = 6)")
    stripes = M.merge_stripes(kept, images, 3, 1, 2, stripe_bytes=5 * 16 * 8)  # five rows of 16 values
    return to_pixels(stripes, "missing", "stripe", "y0").withColumn("y", F.col("y") + F.col("y0")).drop("y0")


@query("crop_output", "I08", f"{cte('pixels')}, {gather('pixels', '16', '16', 'ty // 2', 'tx // 2')}")
def _(t):
    large = M.upsample_nearest(M.pad_flip(t.images(), 8), 2)
    return to_pixels(M.crop_output(large.withColumn("orig_h", F.lit(8)).withColumn("orig_w", F.lit(8)), 2))


@query("merge_alpha", "I10", f"{cte('bgra')} SELECT image_id, y, x, c, v FROM bgra")
def _(t):
    parts = M.split_mode(t.images("bgra"))
    return to_pixels(M.merge_alpha(parts.filter("part = 'color'"), parts.filter("part = 'alpha'")))


@query("to_blocks", "I11", f"{cte('pixels')} SELECT image_id, y // 4 AS block_y, x // 4 AS block_x, y % 4 AS y, x % 4 AS x, c, v FROM pixels")
def _(t):
    return to_pixels(M.to_blocks(t.images(), 4), "block_y", "block_x")


@query("from_blocks", "I11", f"{cte('pixels')} SELECT image_id, y, x, c, v FROM pixels")
def _(t):
    return to_pixels(M.from_blocks(M.to_blocks(t.images(), 4), t.images(), 4))


@query("depth_to_space", "I12", f"{cte('bgra')} SELECT image_id, y * 2 + c // 2 AS y, x * 2 + c % 2 AS x, 0 AS c, v FROM bgra")
def _(t):
    return to_pixels(M.depth_to_space(t.images("bgra"), 2))


@query("space_to_depth", "I13", f"{cte('pixels')} SELECT image_id, y // 2 AS y, x // 2 AS x, (x % 2) * 2 + y % 2 AS c, v FROM pixels")
def _(t):
    return to_pixels(M.space_to_depth(t.images()))


@query("upsample_nearest", "I14", f"{cte('pixels')}, {gather('pixels', '24', '24', 'ty // 3', 'tx // 3')}")
def _(t):
    return to_pixels(M.upsample_nearest(t.images(), 3))


@query("normalize_channels", "I16", f"{cte('bgra')} SELECT image_id, y, x, c, round((v / 255 - (0.4::double + c * 0.05::double)) / (0.2::double + c * 0.1::double), 6) AS v FROM bgra")
def _(t):
    scaled = t.images("bgra").withColumn("data", F.transform("data", lambda v: v / 255))
    return rounded(to_pixels(M.normalize(scaled, [0.4, 0.45, 0.5, 0.55], [0.2, 0.3, 0.4, 0.5])))


# Lanczos-4 at 3/4 of 8 pixels: the source centre of output i is (i + 0.5) * 4/3 - 0.5, eight taps around it.
LANCZOS = """taps AS (SELECT cast(i AS int) AS i, cast(least(greatest(floor(p) + k, 0), 7) AS int) AS s, CASE WHEN p - floor(p) - k = 0 THEN 1.0::double ELSE sin(pi() * (p - floor(p) - k)) / (pi() * (p - floor(p) - k)) * sin(pi() * (p - floor(p) - k) / 4) / (pi() * (p - floor(p) - k) / 4) END AS u
 FROM (SELECT i, (i + 0.5::double) * 8 / 6 - 0.5::double AS p FROM range(0, 6) r(i)) c, range(-3, 5) q(k)),
wt AS (SELECT i, s, sum(u) / (SELECT sum(u) FROM taps b WHERE b.i = a.i) AS w FROM taps a GROUP BY i, s)"""


@query("resize_to", "I15", f"{cte('pixels')}, {LANCZOS} SELECT image_id, a.i AS y, b.i AS x, c, round(sum(a.w * b.w * v) + 1e-9::double, 6) AS v FROM pixels p JOIN wt a ON a.s = p.y JOIN wt b ON b.s = p.x GROUP BY ALL")
def _(t):
    return rounded_off_ties(to_pixels(M.resize_to(t.images().withColumn("orig_h", F.col("h")).withColumn("orig_w", F.col("w")), 0.75)))


@query("upscale", "X01 I01 I02 I03 I06 I07 I08 I09 I10", f"""{cte('pixels', 'bgra')}, a AS (WITH {gather('pixels', '16', '16', 'ty // 2', 'tx // 2')}), b AS (WITH {gather('bgra', '8', '8', 'ty // 2', 'tx // 2', 'tc', '4')})
SELECT image_id, 'L' AS mode, 0 AS missing, y, x, c, v FROM a UNION ALL SELECT image_id + 1000000, 'RGBA', 0, y, x, c, v FROM b""")
def _(t):
    both = t.images().unionByName(t.images("bgra").withColumn("image_id", F.col("image_id") + 1000000))
    return to_pixels(upscale(both, lambda key: 2, nearest_predict, "double", scale=2, tile=4, tile_pad=1, pre_pad=3), "mode", "missing")
