"""Round trips and properties of the image jobs."""

import gzip
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frameline.functions import pixels as P
from frameline.operators import images as M
from frameline.operators import infer as X
from frameline.operators import synth as S
from frameline.operators.image_rows import to_pixels

SHAPE = "image_id long, h int, w int, c int, data array<double>"


def table(spark, *arrays):
    rows = [(i, *a.shape, a.astype(float).ravel().tolist()) for i, a in enumerate(arrays)]
    return spark.createDataFrame(rows, SHAPE)


def arrays(df):
    return {r.image_id: np.array(r.data).reshape(r.h, r.w, r.c) for r in df.collect()}


@pytest.fixture(scope="module")
def some():
    rng = np.random.default_rng(3)
    return [rng.integers(0, 256, (h, w, c)) for h, w, c in ((7, 11, 3), (8, 8, 1), (1, 5, 4), (13, 4, 3))]


@pytest.mark.parametrize("tile,pad,scale", [(3, 1, 1), (4, 2, 2), (64, 10, 3)])
def test_cut_enlarge_merge(spark, some, tile, pad, scale):
    df = table(spark, *some)
    tiles = M.upsample_nearest(M.cut_tiles(df, tile, pad), scale, ("image_id", "tile_id"))
    got = arrays(M.merge_tiles(tiles, df, tile, pad, scale).filter("missing = 0"))
    for i, a in enumerate(some):
        assert np.array_equal(got[i], P.upsample_nearest(a, scale))


@pytest.mark.parametrize("tile,pad,scale,limit", [(3, 1, 1, 1), (4, 2, 2, 700), (64, 10, 3, 10**9), (2, 0, 4, 2000)])
def test_stripes_are_the_image(spark, some, tile, pad, scale, limit):
    df = table(spark, *some)
    tiles = M.upsample_nearest(M.cut_tiles(df, tile, pad), scale, ("image_id", "tile_id"))
    rows = M.merge_stripes(tiles, df, tile, pad, scale, limit).collect()
    for i, a in enumerate(some):
        own = sorted((r for r in rows if r.image_id == i), key=lambda r: r.stripe)
        assert [r.stripe for r in own] == list(range(len(own))) and not any(r.missing for r in own)
        assert [r.y0 for r in own] == [sum(x.h for x in own[:k]) for k in range(len(own))]
        assert all(len(r.data) * 8 <= max(limit, r.w * r.c * 8) for r in own)
        assert np.array_equal(np.concatenate([np.array(r.data).reshape(r.h, r.w, r.c) for r in own]), P.upsample_nearest(a, scale))


def test_stripes_of_a_large_image_stay_within_the_bound(spark, some):
    rows = M.stripe_rows(3840, 3, 4)
    assert rows * 3840 * 4 * 3 * 8 <= M.STRIPE_BYTES < (rows + 1) * 3840 * 4 * 3 * 8 and rows > 100
    df = table(spark, some[0])  # 7 x 11: 2 x 3 tiles of 4
    only = M.merge_stripes(M.cut_tiles(df, 4, 1).filter("tile_id = 1"), df, 4, 1, stripe_bytes=11 * 3 * 8 * 2).orderBy("stripe").collect()
    assert [(r.missing, r.h) for r in only] == [(2, 2), (2, 2), (3, 2), (3, 1)]
    none = M.merge_stripes(M.cut_tiles(df, 4, 1).limit(0), df, 4, 1).collect()
    assert [(r.missing, sum(r.data)) for r in none] == [(6, 0.0)]


def test_cut_tiles_match_the_grid(spark, some):
    df = table(spark, *some)
    grid = {(r.image_id, r.tile_id): (r.pad_y1 - r.pad_y0, r.pad_x1 - r.pad_x0) for r in M.tile_grid(df, 3, 1).collect()}
    assert {(r.image_id, r.tile_id): (r.h, r.w) for r in M.cut_tiles(df, 3, 1).collect()} == grid


def test_pixel_form_equals_array_form(spark, some):
    df = table(spark, *some)
    pixel = M.tile_pixels(to_pixels(df), df, 3, 1).groupBy("image_id", "tile_id").agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    whole = M.cut_tiles(df, 3, 1).select("image_id", "tile_id", F.size("data").cast("long").alias("n"), X.checksum(F.col("data")).alias("v"))
    assert sorted(map(tuple, pixel.collect())) == sorted(map(tuple, whole.collect()))


def test_missing_tiles_are_counted(spark, some):
    df = table(spark, some[0])
    got = M.merge_tiles(M.cut_tiles(df, 4, 1).filter("tile_id = 1"), df, 4, 1).first()
    assert (got.missing, got.h, got.w) == (5, 7, 11)
    none = M.merge_tiles(M.cut_tiles(df, 4, 1).filter("false"), df, 4, 1).first()
    assert none.missing == 6 and sum(none.data) == 0


def test_blocks_round_trip(spark):
    a = np.arange(8 * 12 * 2).reshape(8, 12, 2)
    df = table(spark, a)
    assert np.array_equal(arrays(M.from_blocks(M.to_blocks(df, 4), df, 4))[0], a)


def test_modes(spark, some):
    parts = M.split_mode(table(spark, *some)).collect()
    assert sorted((r.image_id, r["mode"], r.part, r.c) for r in parts) == [
        (0, "RGB", "color", 3), (1, "L", "color", 3), (2, "RGBA", "alpha", 1), (2, "RGBA", "color", 3), (3, "RGB", "color", 3)]
    both = M.split_mode(table(spark, *some)).filter("mode = 'RGBA'")
    back = M.merge_alpha(both.filter("part = 'color'"), both.filter("part = 'alpha'"))
    assert np.array_equal(arrays(back)[2], some[2])


def test_quantize_rounds_half_to_even(spark):
    df = table(spark, np.array([[[0.5 / 255], [1.5 / 255], [-1.0], [2.0]]])).withColumn("max_range", F.lit(255))
    assert M.quantize(df).first().data == [0.0, 2.0, 0.0, 255.0]


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(1, 20), st.sampled_from(["area", "nearest", "bilinear", "bicubic", "lanczos4"]))
def test_resize_keeps_constants(h, w, out, mode):
    assert np.allclose(P.resize(np.full((h, w, 2), 3.5), out, out, mode), 3.5)


def test_same_size_resize_is_identity():
    a = np.random.default_rng(0).random((6, 5, 1))
    for mode in ("area", "nearest", "bilinear", "bicubic", "lanczos4"):
        assert np.allclose(P.resize(a, 6, 5, mode), a)


def test_space_and_depth():
    a = np.arange(4 * 6 * 1).reshape(4, 6, 1)
    assert P.space_to_depth(a)[0, 0].tolist() == [0, 6, 1, 7]
    assert np.array_equal(P.depth_to_space(P.space_to_depth(a)[:, :, [0, 2, 1, 3]], 2), a)


def test_kernels():
    assert np.allclose(P.bessel_j1(np.array([0.0, 1.0, 3.8317059702])), [0.0, 0.4400505857, 0.0], atol=1e-9)
    for kind in S.KERNELS:
        k = P.blur_kernel(kind, 9, 2.0, 1.0, 0.4, 1.3)
        assert math.isclose(k.sum(), 1.0) and np.allclose(k, k[::-1, ::-1])
    assert math.isclose(P.sinc_kernel(1.2, 21).sum(), 1.0)
    a = np.random.default_rng(1).random((30, 30, 3))
    assert np.allclose(P.filter2d(a, P.pulse()), a)


def test_degrade_shape_hook_and_repeat(spark):
    rng = np.random.default_rng(5)
    df = S.draw_params(table(spark, *[rng.random((32, 48, 3)) for _ in range(4)]), seed=9)
    calls = S.degrade(df, jpeg_hook=lambda img, q: img * 0.0 if not 30 <= q <= 95 else img)
    once, twice = arrays(S.degrade(df, jpeg_hook=lambda img, q: img)), arrays(calls.repartition(3))
    assert all(a.shape == (8, 12, 3) and a.min() >= 0 and a.max() <= 1 for a in once.values())
    assert all(np.array_equal(once[i], twice[i]) for i in once)
    flat = arrays(S.degrade(df, jpeg_hook=lambda img, q: img, gt_usm=False))
    assert any(not np.array_equal(once[i], flat[i]) for i in once)


def test_noise_is_seeded_and_clipped(spark):
    df = S.draw_params(table(spark, *[np.full((16, 16, 3), 0.5) for _ in range(6)]))
    a, b = arrays(S.add_noise(df)), arrays(S.add_noise(df.repartition(2)))
    assert all(np.array_equal(a[i], b[i]) and a[i].min() >= 0 and a[i].max() <= 1 for i in a)
    assert any(not np.allclose(a[i], 0.5) for i in a)


def test_noise_has_the_drawn_moments(spark):
    """Many places: mean 0 and the drawn spread for normal noise, mean 0 and the variance of a Poisson count for the other."""
    from frameline.functions import draws as D

    z = D.place_normals(D.key32(1, 2, "x"), 200_000)
    assert abs(z.mean()) < 0.01 and abs(z.std() - 1) < 0.01 and abs((z**3).mean()) < 0.05
    for mean in (0.25, 3.0, 40.0, 256.0):
        k = D.place_poissons(D.key32(1, 2, mean), np.full((400, 500), mean))
        assert abs(k.mean() - mean) < 0.02 * math.sqrt(mean) and abs(k.var() / mean - 1) < 0.02
    assert not D.place_poissons(5, np.zeros((3, 3))).any()
    u = [D.place_uniforms(k, 50_000, s) for k in (1, 2) for s in (0, 1)]
    assert max(abs(np.corrcoef(a, b)[0, 1]) for i, a in enumerate(u) for b in u[:i]) < 0.02


def test_noise_of_a_place_does_not_depend_on_its_batch(spark):
    df = S.draw_params(table(spark, *[np.full((5, 3 + i, 3), 0.1 * i) for i in range(7)]))
    whole = arrays(S.add_noise(df, "second"))
    for i in range(7):
        assert np.array_equal(arrays(S.add_noise(df.filter(F.col("image_id") == i), "second"))[i], whole[i])


def test_block_compression():
    rng = np.random.default_rng(5)
    for shape in ((16, 16, 3), (17, 5, 3), (1, 1, 1), (33, 40, 1), (9, 9, 4)):
        img = rng.random(shape)
        out = {q: P.jpeg(img, q) for q in (5.0, 49.9, 50.0, 95.0, 100.0)}
        assert all(o.shape == shape and o.min() >= 0 and o.max() <= 1 for o in out.values())
        errors = [float(np.abs(out[q] - img).mean()) for q in (5.0, 50.0, 95.0)]
        assert errors == sorted(errors, reverse=True)
        if shape[2] != 3:
            assert np.allclose(out[100.0], img)  # nothing is quantised at the highest quality
    flat = np.full((16, 24, 3), 128 / 255)
    assert np.allclose(P.jpeg(flat, 90.0), flat, atol=1e-6)


def test_degradation_compresses_by_default(spark):
    df = S.draw_params(table(spark, *[np.random.default_rng(i).random((24, 24, 3)) for i in range(3)]))
    plain, without = arrays(S.degrade(df)), arrays(S.degrade(df, jpeg_hook=lambda img, q: img))
    assert all(plain[i].shape == (6, 6, 3) and not np.array_equal(plain[i], without[i]) for i in plain)


def test_pool_must_fit(spark):
    with pytest.raises(ValueError):
        S.shuffle_pairs(spark.range(3).withColumnRenamed("id", "image_id"), 10, 4)


def test_blend_refuses_other_weights(spark):
    a = spark.createDataFrame([("x", [1.0]), ("y", [2.0])], "name string, values array<double>")
    with pytest.raises(Exception, match="weights do not match"):
        S.blend_weights(a, a.filter("name = 'x'"), 0.5, 0.5).collect()


def test_inference_reports_failures_per_row(spark):
    rows = [("j", i, "out", "real_sr", 2, 2, 1, None if i == 1 else [float(i)] * 4) for i in range(4)]
    asked = spark.createDataFrame(rows, "job_id string, batch_id long, output_file_path string, model_key string, h int, w int, c int, data array<double>")

    def predict(model, img, row):
        if row["batch_id"] == 2:
            raise RuntimeError("boom")
        return X.nearest_predict(model, img, row)

    got = {r.batch_id: (r.status, r.error, len(r.data)) for r in X.infer(asked, X.nearest_loader, predict, tasks=2).collect()}
    assert got == {0: (200, None, 64), 1: (500, "Failed to read image", 0), 2: (500, "boom", 0), 3: (200, None, 64)}


def test_registry_keeps_the_last_used():
    loaded = []
    registry = X.ModelRegistry(lambda key: loaded.append(key) or key, max_models=2)
    X.ModelRegistry._cached.clear()
    for key in ("a", "b", "a", "c", "a", "b"):
        assert registry.get(key) == key
    assert loaded == ["a", "b", "c", "b"]


def test_gzip_is_repeatable(spark):
    df = spark.createDataFrame([("a.png", bytearray(b"x" * 500)), ("b.png", None)], "key string, content binary")
    one = {r.key: r for r in X.gzip_content(df).collect()}
    assert gzip.decompress(bytes(one["a.png.gz"].content)) == b"x" * 500 and one["a.png.gz"].new_size < 500
    assert one["b.png.gz"].content is None
    assert bytes(one["a.png.gz"].content) == bytes(X.gzip_content(df).filter("key = 'a.png.gz'").first().content)
