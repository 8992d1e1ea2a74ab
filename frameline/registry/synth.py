"""Queries over training-pair synthesis."""

import math

from pyspark.sql import functions as F

from frameline.fixtures import cte
from frameline.functions import draws
from frameline.functions import pixels as P
from frameline.operators import images as M
from frameline.operators import synth as S
from frameline.operators.image_rows import spread, to_pixels
from frameline.registry import query
from frameline.registry.images import gather, rounded, rounded_off_ties

RECIPE = S.Recipe()


def u(*parts: str, seed: int = 0, id: str = "image_id") -> str:
    text = f"'{seed}/' || {id}" + "".join(f" || '/{p}'" for p in parts)
    return f"(cast('0x' || substr(md5({text}), 1, 8) AS ubigint)::double / 4294967296)"


def span(draw: str, low, high) -> str:
    return f"({low}::double + {draw} * ({high}::double - {low}::double))"


def pick(draw: str, names, weights=None) -> str:
    weights = [1.0] * len(names) if weights is None else weights
    upto, cases = 0.0, ""
    for name, weight in list(zip(names, weights))[:-1]:
        upto += weight
        cases += f" WHEN {draw} < {round(upto / sum(weights), 12)!r}::double THEN '{name}'"
    return f"CASE{cases} ELSE '{names[-1]}' END"


def stage_sql(stage: S.Stage, name: str) -> str:
    d = lambda n: u(name, n)
    size = f"(7 + 2 * floor({d('size')} * 8))"
    kernel = f"CASE WHEN {d('sinc')} < {stage.sinc_prob}::double THEN 'sinc' ELSE {pick(d('kernel'), S.KERNELS, stage.kernel_prob)} END"
    resize = pick(d("resize"), ("up", "down", "keep"), stage.resize_prob)
    plateau = f"({kernel}) LIKE 'plateau%'"
    low, high = (f"(CASE WHEN {plateau} THEN {stage.betap[i]} ELSE {stage.betag[i]} END)" for i in (0, 1))
    noise = f"{d('noise')} < {stage.gaussian_prob}::double"
    return ", ".join(f"{v} AS {name}_{k}" for k, v in {
        "size": f"cast({size} AS int)", "kernel": kernel,
        "cutoff": f"round({span(d('cutoff'), f'(CASE WHEN {size} < 13 THEN {math.pi / 3!r} ELSE {math.pi / 5!r} END)', repr(math.pi))}, 6)",
        "sigma_x": f"round({span(d('sigma_x'), *stage.blur_sigma)}, 6)",
        "beta": f"round(CASE WHEN {d('beta_side')} < 0.5 THEN {span(d('beta'), low, 1)} ELSE {span(d('beta'), 1, high)} END, 6)",
        "blur": f"{d('blur')} < {stage.blur_prob}", "resize": resize,
        "factor": f"round(CASE {resize} WHEN 'up' THEN {span(d('factor'), 1, stage.resize_range[1])} WHEN 'down' THEN {span(d('factor'), stage.resize_range[0], 1)} ELSE 1.0::double END, 6)",
        "mode": pick(d("mode"), S.RESIZE_MODES), "noise": f"CASE WHEN {noise} THEN 'gaussian' ELSE 'poisson' END",
        "level": f"round(CASE WHEN {noise} THEN {span(d('level'), *stage.noise_range)} ELSE {span(d('level'), *stage.poisson_range)} END, 6)",
        "gray": f"{d('gray')} < {stage.gray_prob}::double", "jpeg": f"round({span(d('jpeg'), *stage.jpeg_range)}, 6)",
    }.items())


@query("draw_params", "D01", f"""SELECT image_id, {stage_sql(RECIPE.first, 'first')}, {stage_sql(RECIPE.second, 'second')}, {u('final', 'sinc')} < 0.8::double AS final_sinc, {u('final', 'order')} < 0.5 AS resize_before_jpeg
FROM (SELECT vec_id AS image_id FROM embeddings) i""")
def _(t):
    drawn = S.draw_params(t.images().select("image_id"))
    kept = [f"{s}_{k}" for s in ("first", "second") for k in ("size", "kernel", "cutoff", "sigma_x", "beta", "blur", "resize", "factor", "mode", "noise", "level", "gray", "jpeg")]
    real = ("cutoff", "sigma_x", "beta", "factor", "level", "jpeg")
    return drawn.select("image_id", *[F.round(f"draw.{c}", 6).alias(c) if c.endswith(real) else F.col(f"draw.{c}") for c in kept], "draw.final_sinc", "draw.resize_before_jpeg")


@query("fit_size_crop", "D02", f"""{cte('pixels')}, s AS (SELECT *, floor({u('top')} * 3) AS top, floor({u('left')} * 3) AS left_ FROM pixels)
SELECT image_id, cast(y - top AS int) AS y, cast(x - left_ AS int) AS x, c, v FROM s WHERE y >= top AND y < top + 6 AND x >= left_ AND x < left_ + 6""")
def _(t):
    return to_pixels(S.fit_size(t.images(), 6))


@query("fit_size_pad", "D02", f"{cte('pixels')}, {gather('pixels', '12', '12', 'CASE WHEN ty >= 8 THEN 14 - ty ELSE ty END', 'CASE WHEN tx >= 8 THEN 14 - tx ELSE tx END')}")
def _(t):
    return to_pixels(S.fit_size(t.images(), 12))


MIRROR = "CASE WHEN {0} < 0 THEN -({0}) WHEN {0} > 7 THEN 14 - ({0}) ELSE {0} END"


@query("filter2d", "D03", f"""{cte('pixels')}, k AS (SELECT cast(i AS int) AS i, cast(j AS int) AS j FROM range(0, 3) a(i), range(0, 3) b(j)),
n AS (SELECT t.image_id, t.y, t.x, t.c, (t.image_id % 5 + i * 3 + j)::double / 10 AS kv, {MIRROR.format('(t.y + i - 1)')} AS sy, {MIRROR.format('(t.x + j - 1)')} AS sx FROM pixels t, k)
SELECT n.image_id, n.y, n.x, n.c, round(sum(kv * s.v), 6) AS v FROM n JOIN pixels s ON s.image_id = n.image_id AND s.y = n.sy AND s.x = n.sx AND s.c = n.c GROUP BY ALL""")
def _(t):
    own = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda i: (F.col("image_id") % 5 + i).cast("double") / 10)
    return rounded(to_pixels(S.filter2d(t.images().withColumn("kernel", own))))


@query("resize_area", "D04", f"{cte('pixels')} SELECT image_id, y // 2 AS y, x // 2 AS x, c, round(avg(v), 6) AS v FROM pixels GROUP BY 1, 2, 3, 4")
def _(t):
    return rounded(to_pixels(S.resize(t.images(), 4, 4, "area")))


def weights(n_in: int, n_out: int, lo: int, hi: int, formula: str, centre: str = "p") -> str:
    return f"""w AS (SELECT i, cast(least(greatest(floor({centre}) + k, 0), {n_in - 1}) AS int) AS s, sum({formula}) AS w FROM (SELECT i, p, {centre} - floor({centre}) AS t FROM (SELECT cast(i AS int) AS i, (i + 0.5::double) * {n_in} / {n_out} - 0.5::double AS p FROM range(0, {n_out}) r(i)) c) d, range({lo}, {hi}) q(k) GROUP BY 1, 2)
SELECT image_id, a.i AS y, b.i AS x, c, round(sum(a.w * b.w * v) + 1e-9::double, 6) AS v FROM pixels p JOIN w a ON a.s = p.y JOIN w b ON b.s = p.x GROUP BY ALL"""


@query("resize_bilinear", "D04", f"{cte('pixels')}, {weights(8, 12, 0, 2, 'CASE k WHEN 0 THEN 1 - t ELSE t END', 'greatest(p, 0)')}")
def _(t):
    return rounded_off_ties(to_pixels(S.resize(t.images(), 12, 12, "bilinear")))


D = "abs(t - k)"
CUBIC = f"CASE WHEN {D} <= 1 THEN (1.25 * {D} - 2.25) * {D} * {D} + 1 ELSE (({D} - 5) * {D} + 8) * {D} * -0.75 + 3 END"


@query("resize_bicubic", "D04", f"{cte('pixels')}, {weights(8, 12, -1, 3, CUBIC)}")
def _(t):
    return rounded_off_ties(to_pixels(S.resize(t.images(), 12, 12, "bicubic")))


def unit(t):
    return S.draw_params(t.images().withColumn("data", F.transform("data", lambda v: v / 255)))


def rgb(t):
    """Three of the four channels of the 4x4 images, in [0, 1]."""
    return t.images("bgra").withColumn("data", F.filter("data", lambda v, i: i % 4 < 3)).withColumn("c", F.lit(3)).withColumn("data", F.transform("data", lambda v: v / 255))


# Noise: the hash of every place, both distributions.

HASH = f"""cast('0x' || substr(md5('0/' || image_id || '/' || stage || '/places'), 1, 8) AS ubigint) AS key"""


def uniform_sql(name: str, stream: int) -> str:
    """Lateral columns that end in ``name``: the uniform of a place (``place``, ``key``)."""
    a, b = f"{name}_a", f"{name}_b"

    def mix(x: str, at: str) -> str:
        return (f"xor({x}, {x} >> 16) AS {at}1, ({at}1 * {draws.MIX_1}::ubigint) & {draws.WORD}::ubigint AS {at}2, xor({at}2, {at}2 >> 13) AS {at}3, "
                f"({at}3 * {draws.MIX_2}::ubigint) & {draws.WORD}::ubigint AS {at}4, xor({at}4, {at}4 >> 16) AS {at}5")

    counter = f"((place * 2 + {stream})::ubigint * {draws.STEP}::ubigint) & {draws.WORD}::ubigint AS {a}0"
    return f"{counter}, {mix(f'{a}0', a)}, xor({a}5, key) AS {b}0, {mix(f'{b}0', b)}, ({b}5::double + 0.5::double) / 4294967296::double AS {name}"


def noise_sql(pixels: str, stage: S.Stage, name: str, w: int, c: int) -> str:
    d = lambda n: u(name, n)
    gaussian = f"{d('noise')} < {stage.gaussian_prob}::double"
    weights = " ".join(f"WHEN {i} THEN {x}::double" for i, x in enumerate(S.GRAY))
    return f"""px AS (SELECT image_id, y, x, c, v / 255 AS v FROM ({pixels}) q),
dr AS (SELECT *, '{name}' AS stage, {gaussian} AS gaussian, ({d('gray')} < {stage.gray_prob}::double) AND {c} = 3 AS gray, CASE WHEN {gaussian} THEN {span(d('level'), *stage.noise_range)} ELSE {span(d('level'), *stage.poisson_range)} END AS level FROM (SELECT DISTINCT image_id FROM px) i),
so AS (SELECT image_id, y, x, c AS ch, v AS s, y * {w * c} + x * {c} + c AS place FROM px JOIN dr USING (image_id) WHERE NOT gray
  UNION ALL SELECT image_id, y, x, -1, sum(v * CASE c {weights} ELSE 0::double END), y * {w} + x FROM px JOIN dr USING (image_id) WHERE gray GROUP BY image_id, y, x),
wh AS (SELECT so.*, dr.gaussian, dr.level, dr.stage, greatest(0, least(255, round_even(round(s * 255, 6), 0))) / 255 AS whole FROM so JOIN dr USING (image_id)),
st AS (SELECT image_id, pow(2::double, ceil(log2(count(DISTINCT whole)))) AS steps FROM wh GROUP BY image_id),
un AS (SELECT wh.*, st.steps, whole * steps AS mean, {HASH}, {uniform_sql('u1', 0)}, {uniform_sql('u2', 1)} FROM wh JOIN st USING (image_id)),
pm AS (SELECT mean, k, CASE WHEN mean = 0 THEN 1::double ELSE exp(k * ln(mean) - mean - lgamma(k + 1::double)) END AS p FROM (SELECT DISTINCT mean FROM un WHERE NOT gaussian) m, range(0, 600) r(k) WHERE k < mean + 16 * sqrt(mean) + 32 AND (mean > 0 OR k = 0)),
cd AS (SELECT mean, k, sum(p) OVER (PARTITION BY mean ORDER BY k) AS upto FROM pm),
po AS (SELECT un.image_id, un.place, count(*) FILTER (WHERE cd.upto < un.u1) AS k FROM un JOIN cd ON cd.mean = un.mean WHERE NOT gaussian AND un.mean > 0 GROUP BY 1, 2),
no AS (SELECT un.image_id, un.y, un.x, un.ch, CASE WHEN gaussian THEN sqrt(-2 * ln(u1)) * cos(2 * pi() * u2) * (level / 255) ELSE (coalesce(po.k, 0) / steps - whole) * level END AS noise FROM un LEFT JOIN po ON po.image_id = un.image_id AND po.place = un.place AND NOT un.gaussian)"""


@query("add_noise", "D05", f"{cte('pixels')}, {noise_sql('SELECT * FROM pixels', RECIPE.first, 'first', 8, 1)} SELECT image_id, y, x, px.c, round(greatest(0, least(1, v + noise)), 6) AS v FROM px JOIN no USING (image_id, y, x)")
def _(t):
    return rounded(to_pixels(S.add_noise(unit(t))))


@query("add_noise_colour", "D05", f"{cte('bgra')}, {noise_sql('SELECT * FROM bgra WHERE c < 3', RECIPE.second, 'second', 4, 3)} SELECT image_id, y, x, px.c, round(greatest(0, least(1, v + noise)), 6) AS v FROM px JOIN no USING (image_id, y, x) WHERE no.ch IN (-1, px.c)")
def _(t):
    return rounded(to_pixels(S.add_noise(S.draw_params(rgb(t)), "second")))


# Block compression: sums of cosines, on images with odd sides too.

QUALITY = "(CASE image_id % 3 WHEN 0 THEN 10 WHEN 1 THEN 50 ELSE 90 END)::double"


def steps_sql() -> str:
    rows = [(0, v, h, P.LIGHT_STEPS[h][v]) for v in range(8) for h in range(8)]  # read by columns
    rows += [(1, v, h, P.COLOUR_STEPS[h][v] if max(v, h) < 4 else P.COARSEST_STEP) for v in range(8) for h in range(8)]
    return f"(VALUES {', '.join(map(str, rows))}) q(colour, a, b, step)"


def blocks_sql(planes: str) -> str:
    """``planes`` (image_id, k, y, x, v): one 8x8 block each, with ``v`` in [0, 255]; gives ``back`` of the same form."""
    return f"""bs AS (SELECT cast(f AS int) AS f, cast(z AS int) AS z, cos((2 * z + 1) * f * pi() / 16) * sqrt((CASE f WHEN 0 THEN 1 ELSE 2 END)::double / 8) AS w FROM range(0, 8) a(f), range(0, 8) b(z)),
co AS (SELECT image_id, k, a.f AS a, b.f AS b, round(sum(a.w * b.w * (v - 128)), 6) AS found FROM ({planes}) p JOIN bs a ON a.z = p.y JOIN bs b ON b.z = p.x GROUP BY ALL),
ke AS (SELECT co.image_id, k, co.a, co.b, step * (CASE WHEN {QUALITY} < 50 THEN 5000::double / {QUALITY} ELSE 200::double - 2 * {QUALITY} END / 100) AS by_, round_even(found / by_, 0) * by_ AS kept FROM co JOIN {steps_sql()} ON q.colour = least(co.k, 1) AND q.a = co.a AND q.b = co.b),
back AS (SELECT image_id, k, a.z AS y, b.z AS x, sum(a.w * b.w * kept) + 128 AS v FROM ke JOIN bs a ON a.f = ke.a JOIN bs b ON b.f = ke.b GROUP BY ALL)"""


GRID = "(SELECT cast(i AS int) AS y, cast(j AS int) AS x FROM range(0, 16) a(i), range(0, 16) b(j)) g"


def quality():
    """The column that says in Spark what ``QUALITY`` says in SQL."""
    return F.when(F.col("image_id") % 3 == 0, 10.0).when(F.col("image_id") % 3 == 1, 50.0).otherwise(90.0)


@query("jpeg_blocks", "D06", f"""{cte('pixels')}, px AS (SELECT * FROM pixels WHERE image_id % 2 = 0 OR (y < 7 AND x < 5)),
{blocks_sql(f"SELECT i.image_id, 0 AS k, g.y, g.x, coalesce(px.v, 0) AS v FROM (SELECT DISTINCT image_id FROM px) i CROSS JOIN {GRID} LEFT JOIN px ON px.image_id = i.image_id AND px.y = g.y AND px.x = g.x WHERE g.y < 8 AND g.x < 8")}
SELECT px.image_id, px.y, px.x, px.c, round(greatest(0, least(255, back.v)) / 255 + 1e-9::double, 6) AS v FROM px JOIN back ON back.image_id = px.image_id AND back.y = px.y AND back.x = px.x""")
def _(t):
    odd = F.col("image_id") % 2 == 1
    cut = t.images().withColumn("data", F.transform(F.filter("data", lambda v, i: ~odd | ((i < 56) & (i % 8 < 5))), lambda v: v / 255))
    cut = cut.withColumn("h", F.when(odd, 7).otherwise(8)).withColumn("w", F.when(odd, 5).otherwise(8))
    return rounded_off_ties(to_pixels(S.compress(cut.withColumn("quality", quality()))))


TO_LIGHT = " ".join(f"WHEN {k} THEN CASE c WHEN 0 THEN {a}::double WHEN 1 THEN {b}::double ELSE {c}::double END" for k, (a, b, c) in enumerate(P.TO_LIGHT))
FROM_LIGHT = " ".join(f"WHEN {c} THEN CASE k WHEN 0 THEN {x}::double WHEN 1 THEN {y}::double ELSE {z}::double END" for c, (x, y, z) in enumerate(P.FROM_LIGHT))


@query("jpeg_colour", "D06", f"""{cte('bgra')}, px AS (SELECT * FROM bgra WHERE c < 3), pl AS (SELECT image_id, cast(n AS int) AS k, y, x, sum(v * CASE n {TO_LIGHT} END) AS v FROM px, range(0, 3) r(n) GROUP BY ALL),
full_ AS (SELECT i.image_id, i.k, g.y, g.x, coalesce(pl.v, 0) AS v FROM (SELECT DISTINCT image_id, k FROM pl) i CROSS JOIN {GRID} LEFT JOIN pl ON pl.image_id = i.image_id AND pl.k = i.k AND pl.y = g.y AND pl.x = g.x),
{blocks_sql("SELECT image_id, k, y, x, v FROM full_ WHERE k = 0 AND y < 8 AND x < 8 UNION ALL SELECT image_id, k, y // 2, x // 2, avg(v) + 128 FROM full_ WHERE k > 0 GROUP BY ALL")}
SELECT px.image_id, px.y, px.x, px.c, round(greatest(0, least(255, sum((back.v - CASE k WHEN 0 THEN 0 ELSE 128 END) * CASE px.c {FROM_LIGHT} END))) / 255 + 1e-9::double, 6) AS v
FROM px JOIN back ON back.image_id = px.image_id AND back.y = CASE k WHEN 0 THEN px.y ELSE px.y // 2 END AND back.x = CASE k WHEN 0 THEN px.x ELSE px.x // 2 END GROUP BY px.image_id, px.y, px.x, px.c""")
def _(t):
    return rounded_off_ties(to_pixels(S.compress(rgb(t).withColumn("quality", quality()))))


def large(t):
    scaled = t.images().withColumn("data", F.transform("data", lambda v: v / 255))
    return M.upsample_nearest(spread(scaled, t.spark.sparkContext.defaultParallelism), 4)


@query("degrade", "D06 D07 D03 D04 D05")
def _(t):
    return rounded(to_pixels(S.degrade(S.draw_params(large(t)))))


@query("degrade_unsharpened", "D12")
def _(t):
    return rounded(to_pixels(S.degrade(S.draw_params(large(t)), gt_usm=False)))


def sides(t):
    high = t.images()
    low = S.resize(high, 4, 4, "area").withColumn("side_scale", F.lit(1))
    return low.unionByName(high.withColumn("side_scale", F.lit(2)))


BOTH = "both_ AS (SELECT image_id, 2 AS side_scale, y, x, c, v FROM pixels UNION ALL SELECT image_id, 1, y // 2, x // 2, c, avg(v) FROM pixels GROUP BY image_id, y // 2, x // 2, c)"


@query("paired_crop", "D08", f"""{cte('pixels')}, {BOTH}, s AS (SELECT *, floor({u('crop_top')} * 3) * side_scale AS top, floor({u('crop_left')} * 3) * side_scale AS left_ FROM both_)
SELECT image_id, side_scale, cast(y - top AS int) AS y, cast(x - left_ AS int) AS x, c, round(v, 6) AS v FROM s WHERE y >= top AND y < top + 2 * side_scale AND x >= left_ AND x < left_ + 2 * side_scale""")
def _(t):
    return rounded(to_pixels(S.paired_crop(sides(t), 2), "side_scale"))


@query("augment", "D09", f"""{cte('pixels')}, {BOTH}, s AS (SELECT *, 4 * side_scale - 1 AS e, {u('flip_x')} < 0.5 AS fx, {u('flip_y')} < 0.5 AS fy, {u('swap')} < 0.5 AS sw FROM both_),
f AS (SELECT image_id, side_scale, c, v, sw, CASE WHEN fy THEN e - y ELSE y END AS y1, CASE WHEN fx THEN e - x ELSE x END AS x1 FROM s)
SELECT image_id, side_scale, CASE WHEN sw THEN x1 ELSE y1 END AS y, CASE WHEN sw THEN y1 ELSE x1 END AS x, c, round(v, 6) AS v FROM f""")
def _(t):
    return rounded(to_pixels(S.augment(sides(t), keep=("image_id", "side_scale")), "side_scale"))


@query("shuffle_pairs", "D10", """WITH r AS (SELECT vec_id AS image_id, row_number() OVER (ORDER BY cast('0x' || substr(md5('0/' || vec_id || '/order'), 1, 8) AS ubigint), vec_id) - 1 AS position FROM embeddings)
SELECT image_id, position, position // 12 AS batch, position // 180 AS pool FROM r""")
def _(t):
    return S.shuffle_pairs(t.images().select("image_id"), 180, 12)


@query("replace_unreadable", "D11", f"""WITH m AS (SELECT doc_id AS item, 'doc_' || doc_id || '.png' AS path FROM documents), good AS (SELECT * FROM m WHERE item % 3 <> 0),
n AS (SELECT path AS new_path, row_number() OVER (ORDER BY cast('0x' || substr(md5('0/' || path), 1, 8) AS ubigint), path) AS k FROM good),
bad AS (SELECT item, floor({u('replace', id='item')} * (SELECT count(*) FROM good)) + 1 AS k FROM m WHERE item % 3 = 0)
SELECT item, path, false AS replaced FROM good UNION ALL SELECT item, new_path, true FROM bad JOIN n ON n.k = bad.k""")
def _(t):
    manifest = t("payloads").selectExpr("doc_id AS item", "'doc_' || doc_id || '.png' AS path")
    return S.replace_unreadable(manifest, manifest.filter("item % 3 = 0").select("path"))


@query("pair_images", "J14", """SELECT CASE WHEN vec_id % 10 <> 4 THEN 'gt/' || vec_id || '.png' END AS gt_path, CASE WHEN vec_id % 10 <> 3 THEN 'lq/' || vec_id || 'x4.png' END AS lq_path,
CASE WHEN vec_id % 10 = 3 THEN 'no low-quality file' WHEN vec_id % 10 = 4 THEN 'no high-quality file' END AS error FROM embeddings""")
def _(t):
    ids = t.raw("embeddings").select("vec_id")
    gt = ids.filter("vec_id % 10 <> 4").selectExpr("'gt/' || vec_id || '.png' AS gt_path")
    lq = ids.filter("vec_id % 10 <> 3").selectExpr("'lq/' || vec_id || 'x4.png' AS lq_path")
    return S.pair_images(lq, gt, "{}x4")


@query("pair_images_by_folder", "J14", """WITH f AS (SELECT vec_id, vec_id % 7 AS folder, vec_id // 50 AS stem FROM embeddings), g AS (SELECT folder, stem, count(*) AS n FROM f WHERE vec_id % 10 <> 4 GROUP BY ALL), q AS (SELECT folder, stem, count(*) AS n FROM f WHERE vec_id % 10 <> 3 GROUP BY ALL)
SELECT folder, coalesce(cast(sum(g.n * q.n) AS bigint), 0) AS pairs, coalesce(cast(sum(g.n) FILTER (WHERE q.n IS NULL) AS bigint), 0) AS alone_high, coalesce(cast(sum(q.n) FILTER (WHERE g.n IS NULL) AS bigint), 0) AS alone_low FROM g FULL JOIN q USING (folder, stem) GROUP BY folder""")
def _(t):
    ids = t.raw("embeddings").selectExpr("vec_id", "vec_id % 7 AS folder", "vec_id div 50 AS stem")
    gt = ids.filter("vec_id % 10 <> 4").selectExpr("'gt/set/' || folder || '/' || stem || '.png' AS gt_path")
    lq = ids.filter("vec_id % 10 <> 3").selectExpr("'lq/' || folder || '/' || stem || 'x4.png' AS lq_path")
    paired = S.pair_images(lq, gt, "{}x4", lq_root="lq", gt_root="gt/set/")
    folder = F.coalesce(F.split("gt_path", "/")[2], F.split("lq_path", "/")[1]).cast("long").alias("folder")
    return paired.groupBy(folder).agg(F.count_if(F.col("error").isNull()).alias("pairs"), F.count_if(F.col("lq_path").isNull()).alias("alone_high"), F.count_if(F.col("gt_path").isNull()).alias("alone_low"))


@query("blend_weights", "J15", f"""WITH a AS (SELECT vec_id AS name, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
SELECT name, i - 1 AS i, round(v::double * 0.25::double + (v::double * 2 + 1) * 0.75::double, 6) AS v FROM a""")
def _(t):
    a = t.raw("embeddings").select(F.col("vec_id").alias("name"), F.col("embedding").alias("values"))
    b = a.withColumn("values", F.transform("values", lambda v: v.cast("double") * 2 + 1))
    return S.blend_weights(a, b, 0.25, 0.75).select("name", F.posexplode("values").alias("i", "v")).withColumn("v", F.round("v", 6)).withColumn("i", F.col("i").cast("long"))
