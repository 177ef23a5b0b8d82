"""Neighbourhood, background and texture operators against array code on small grids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelspark.functions import kernels as K
from pixelspark.operators import background as bg
from pixelspark.operators import stencil as st
from pixelspark.operators import tensors as tn
from pixelspark.operators import texture as tex
from pixelspark.operators.blocks import image_size, map_blocks, map_tiles, pack_tiles
from pixelspark.sources.tables import fov_shape

RNG = np.random.default_rng(11)


def array(df, value="value", image=None):
    df = df if image is None else df.where(F.col("image_id") == image)
    rows = df.select("y", "x", value).collect()
    out = np.full((max(r.y for r in rows) + 1, max(r.x for r in rows) + 1), np.nan)
    for r in rows:
        out[r.y, r.x] = np.nan if r[value] is None else r[value]
    return out


@pytest.fixture(scope="module")
def picture():
    return np.round(RNG.normal(size=(23, 31)) * 100)


@pytest.mark.parametrize("block", [5, 8, 64])
@pytest.mark.parametrize("mode", ["symmetric", "reflect", "nearest", "constant"])
def test_tiles_equal_whole_image(grid, picture, block, mode):
    k = RNG.normal(size=(5, 3))
    got = st.convolve(grid({1: picture}), k, mode, block=block)
    assert got.count() == picture.size
    np.testing.assert_allclose(array(got), K.correlate(picture, k[::-1, ::-1], mode), atol=1e-9)


@pytest.mark.parametrize("block", [6, 64])
def test_packed_tiles_serve_many_kernels(spark, grid, picture, tmp_path, block):
    pack_tiles(grid({1: picture, 2: picture[:9, :4]}), 2, block).write.parquet(f"{tmp_path}/tiles")
    tiles = spark.read.parquet(f"{tmp_path}/tiles")
    fp = np.ones((3, 3), bool)
    median = map_tiles(tiles, lambda a: K.LOCAL["median"](K.windows(a, fp, "symmetric")), ["value"])
    np.testing.assert_array_equal(array(median, image=1), array(st.median_filter(grid({1: picture}))))
    np.testing.assert_array_equal(array(median, image=2), array(st.median_filter(grid({2: picture[:9, :4]}))))
    smooth = map_tiles(tiles, lambda a: K.gaussian(a, 0.5, "nearest"), ["value"])
    np.testing.assert_allclose(array(smooth, image=1), K.gaussian(picture, 0.5, "nearest"), atol=1e-9)
    assert "Exchange" not in smooth._jdf.queryExecution().executedPlan().toString()


def test_many_images_in_one_task(grid):
    images = {i: RNG.integers(0, 50, size=(3 + i % 4, 2 + i % 5)) for i in range(40)}
    got = st.median_filter(grid(images), 3, block=4)
    for i in (0, 7, 39):
        np.testing.assert_allclose(array(got, image=i), K.LOCAL["median"](K.windows(images[i].astype(float), np.ones((3, 3), bool), "symmetric")))


def test_center_values(grid):
    a = np.arange(1, 10).reshape(3, 3)
    assert array(st.median_filter(grid({1: a})))[1, 1] == 5
    assert array(st.convolve(grid({1: a}), [[0, 1, 0], [1, -4, 1], [0, 1, 0]]))[1, 1] == 0


def test_halo_must_fit(grid):
    with pytest.raises(ValueError):
        map_blocks(grid({1: [[1]]}), lambda a: a, ["v"], halo=9, block=4)


def test_string_image_ids(spark):
    df = spark.createDataFrame([(f"img{i}", 0, 0, x, float(x)) for i in range(5) for x in range(4)],
                               "image_id string, channel int, y int, x int, value double")
    got = st.local_map(df, "max", 3)
    assert sorted(r.value for r in got.where("image_id = 'img3'").collect()) == [1, 2, 3, 3]


def test_missing_value_stays_missing(grid):
    a = np.array([[1.0, np.nan], [3.0, 4.0]])
    assert array(map_blocks(grid({1: a}), lambda v: v + 1, ["value"]))[0, 1] != array(map_blocks(grid({1: a}), lambda v: v + 1, ["value"]))[0, 1]


def test_gaussian_keeps_constant_and_sigma_per_axis(grid):
    a = np.full((9, 9), 4.0)
    np.testing.assert_allclose(array(st.gaussian_filter(grid({1: a}), 1.3)), a)
    b = RNG.normal(size=(12, 10))
    want = K.correlate(K.correlate(b, K.gaussian_weights(0.5)[:, None], "nearest"), K.gaussian_weights(1.5)[None, :], "nearest")
    np.testing.assert_allclose(K.gaussian(b, (0.5, 1.5), "nearest"), want)


@pytest.mark.parametrize("mode", ["reflect", "symmetric", "constant"])
def test_pad_equals_numpy(grid, mode):
    a = RNG.integers(0, 9, size=(5, 7))
    px = grid({1: a})
    got = st.pad(px, 3, fov_shape(px), mode)
    extra = {"constant_values": 0} if mode == "constant" else {}
    np.testing.assert_array_equal(array(got), np.pad(a, 3, mode=mode, **extra))
    assert got.count() == 11 * 13


@pytest.mark.parametrize("target", [(3, 4), (9, 11), (4, 12), (8, 3), (6, 7)])
def test_match_shape(grid, target):
    a = RNG.integers(1, 9, size=(6, 7))
    got = st.match_shape(grid({1: a}), a.shape, target)
    assert array(got).shape == target and got.count() == target[0] * target[1]
    if target[0] >= 6 and target[1] >= 7:
        assert array(got).sum() == a.sum()


def test_resize(grid):
    a = RNG.integers(1, 9, size=(4, 6)).astype(float)
    px = grid({1: a})
    np.testing.assert_allclose(array(st.downsample_mean(px, 2)), a.reshape(2, 2, 3, 2).mean((1, 3)))
    up = st.upsample_nearest(px, (4, 6), (7, 9))
    want = a[(np.arange(7) * 4) // 7][:, (np.arange(9) * 6) // 9]
    np.testing.assert_array_equal(array(up), want)


def _ball(a, r):
    out = np.full(a.shape, np.inf)
    for dy in range(-r, r + 1):
        for dx in range(-r, r + 1):
            if dy * dy + dx * dx <= r * r:
                rise = r - np.sqrt(r * r - dy * dy - dx * dx)
                for y in range(a.shape[0]):
                    for x in range(a.shape[1]):
                        if 0 <= y + dy < a.shape[0] and 0 <= x + dx < a.shape[1]:
                            out[y, x] = min(out[y, x], a[y + dy, x + dx] + rise)
    return out


def test_rolling_ball(grid):
    a = RNG.integers(0, 6, size=(11, 13)).astype(float)
    np.testing.assert_allclose(array(st.rolling_ball(grid({1: a}), 4, block=4)), _ball(a, 4))
    white = array(st.rolling_ball(grid({1: a}), 4, white_background=True, max_value=255, block=5))
    np.testing.assert_allclose(white, 255 - _ball(255 - a, 4))


def test_rolling_ball_settings_per_channel(grid):
    a, b = RNG.integers(0, 6, size=(6, 6)).astype(float), RNG.integers(0, 6, size=(6, 6)).astype(float)
    got = st.rolling_ball_per_channel(grid({1: [a, b]}), {0: 2, 1: 3}, {0: None, 1: 0.5})
    np.testing.assert_allclose(array(got.where("channel = 0")), _ball(a, 2))
    np.testing.assert_allclose(array(got.where("channel = 1")), K.gaussian(_ball(b, 3), 0.5, "symmetric"))


def test_erosion_is_a_minimum(grid):
    a = np.zeros((5, 5), int)
    a[1:4, 1:4] = 3
    sparse = grid({1: a}, "label", "int").where("label > 0")
    assert st.erode_labels(sparse, fov_shape(grid({1: a})), 1).count() == 1
    b = grid({1: np.array([[2, 2, 7, 7, 7, 7]])}, "label", "int")
    assert array(st.erode_labels(b, image_size(b), 1), "label").tolist() == [[2, 2, 2, 7, 7, 7]]


@pytest.mark.parametrize("block", [4, 256])
def test_a_square_off_the_edge_is_eroded_on_all_sides(grid, block):
    a = np.zeros((20, 20), int)
    a[5:10, 6:11] = 3
    sparse = grid({1: a}, "label", "int").where("label > 0")
    size = fov_shape(grid({1: a}))
    kept = {(r["y"], r["x"]) for r in st.erode_labels(sparse, size, 1, block=block).collect()}
    assert kept == {(y, x) for y in range(6, 9) for x in range(7, 10)}
    with pytest.raises(TypeError):
        st.erode_labels(sparse)


def test_surface_equals_least_squares(grid):
    z = RNG.normal(size=(9, 12))
    y, x = np.mgrid[:9, :12]
    for kx, ky, order in ((3, 3, None), (2, 1, None), (3, 3, 3)):
        cols = np.stack([(x ** i * y ** j).ravel() for i in range(kx + 1) for j in range(ky + 1) if order is None or i + j <= order], 1)
        want = (cols @ np.linalg.lstsq(cols.astype(float), z.ravel(), rcond=None)[0]).reshape(z.shape)
        got = bg.polyfit_surface(grid({1: z}).drop("image_id"), kx, ky, order)
        np.testing.assert_allclose(array(got), want, atol=1e-8)
    with pytest.raises(ValueError):
        bg.polyfit_surface(grid({1: z}).drop("image_id"), {0: 3}, 3, None)


def test_correction_guards(grid):
    px = grid({1: [[500, 600], [700, 800]]})
    back = grid({1: [[100, 100], [100, 100]]}).drop("image_id")
    ones = back.withColumn("value", F.lit(1.0))
    np.testing.assert_allclose(array(bg.correct_pixels(px, ones, "division", rescale="max")), array(px), rtol=1e-7)
    for kwargs in ({"rescale": "minmax"}, {"offset": 200, "offset_background": True}, {"method": "division", "offset": 500}):
        with pytest.raises(Exception, match="constant|offset"):
            bg.correct_pixels(px, back, **kwargs).collect()
    with pytest.raises(Exception, match="finite"):
        bg.correct_pixels(px, back.where("x = 0")).collect()
    for kwargs in ({"epsilon": 0}, {"method": "x"}, {"rescale": "x"}):
        with pytest.raises(ValueError):
            bg.correct_pixels(px, back, **kwargs)
    clipped = bg.correct_pixels(px, back, clip=True, clip_min=450, clip_max=None, dtype="int")
    assert sorted(r.value for r in clipped.collect()) == [450, 500, 600, 700]


def test_glcm_hand_grid(grid):
    a = np.array([[0, 0, 1, 1], [0, 0, 1, 1]])
    px = grid({1: a}).withColumn("level", F.col("value").cast("int"))
    counts = tex.glcm(px)
    assert {(r.i, r.j): r.n for r in counts.collect()} == {(0, 0): 4, (0, 1): 2, (1, 0): 2, (1, 1): 4}
    assert counts.agg(F.sum("p")).first()[0] == pytest.approx(1)
    assert tex.glcm_props(counts, ["contrast"]).first().contrast == pytest.approx(4 / 12)
    flat = tex.glcm(px.withColumn("level", F.lit(3)))
    assert tex.glcm_props(flat).first().asDict() | {"image_id": 1} == {
        "image_id": 1, "channel": 0, "d": 0, "a": 0, "contrast": 0, "dissimilarity": 0, "homogeneity": 1, "ASM": 1,
        "energy": 1, "correlation": 1, "mean": 3, "variance": 0, "std": 0, "entropy": 0}
    with pytest.raises(ValueError):
        tex.glcm_props(counts, ["x"])


def _window_contrast(crop, inside, window):
    """Contrast at each inside pixel by direct counting."""
    half = window // 2
    p = np.pad(crop, half, mode="reflect")
    out = {}
    for y, x in zip(*np.nonzero(inside)):
        w = p[y:y + window, x:x + window]
        out[y, x] = ((w[:, 1:] - w[:, :-1]) ** 2).mean()
    return out


@pytest.mark.parametrize("block", [11, 256])
def test_texture_map_of_ragged_object(grid, block):
    image = RNG.integers(10, 90, size=(17, 21)).astype(float)
    labels = np.zeros((17, 21), int)
    labels[2:15, 3:19] = RNG.random((13, 16)) > 0.3
    labels[2, 3] = labels[14, 18] = 1
    crop = np.where(labels[2:15, 3:19] > 0, image[2:15, 3:19], 0)
    lo, hi = np.percentile(crop, (1, 99))
    q = np.floor((np.clip(crop, lo, hi) - lo) / (hi - lo) * 7)
    want = _window_contrast(q, labels[2:15, 3:19], 11)
    got = tex.haralick_map(grid({1: image}), grid({1: labels}, "label", "int"), ["contrast"], block=block).collect()
    assert {(r.y - 2, r.x - 3): r.contrast for r in got} == pytest.approx({(int(a), int(b)): v for (a, b), v in want.items()})


def test_matrix_props_agree_with_counts(grid):
    q = RNG.integers(0, 4, size=(9, 9))
    px = grid({1: q}).withColumn("level", F.col("value").cast("int"))
    whole = tex.glcm_props(tex.glcm(px, [1], [np.pi / 4])).first()
    got = tex.window_props(q.astype(float), 9, [(1, 1)], tex.PROPS, 4)
    assert [a[4, 4] for a in got] == pytest.approx([whole[p] for p in tex.PROPS])


def test_sigma_grid():
    assert tn.sigma_grid() == [(1.0, 1.0)]
    assert tn.sigma_grid(2) == tn.sigma_grid(high=2) == [(2.0, 2.0)]
    assert tn.sigma_grid(1, 3) == [(1.0, 1.0), (3.0, 3.0)]
    assert tn.sigma_grid(1, 3, 3) == [(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)]
    assert tn.sigma_grid((1, 2), (3, 4), 2) == [(1.0, 2.0), (3.0, 4.0)]
    for bad in ((3, 1), ((1, 2), 3), ((1, 2, 3), (4, 5, 6)), (2, 2)):
        with pytest.raises(ValueError):
            tn.sigma_grid(*bad)


def test_hessian_of_a_paraboloid(grid):
    y, x = np.mgrid[:25, :25]
    a = 3.0 * (y - 12) ** 2 + 1.0 * (x - 12) ** 2
    got = tn.hessian_map(grid({1: a}), [(1.0, 1.0)])
    mid = got.where("y = 12 and x = 12").first()
    assert (mid.eigv_1_0, mid.eigv_2_0) == pytest.approx((6.0, 2.0), abs=1e-6)
    tiled = tn.hessian_map(grid({1: a}), [(1.0, 1.0)], block=7)
    np.testing.assert_allclose(array(tiled, "eigv_1_0"), array(got, "eigv_1_0"), atol=1e-8)


def test_structure_tensor_tiles_and_ramp(grid):
    a = RNG.normal(size=(19, 22)) * 10
    one, many = (tn.structure_tensor_map(grid({1: a}), [(1.0, 1.0), (0.5, 2.0)], block=b) for b in (64, 9))
    for c in ("eigv_1_0", "eigv_2_1", "anisotropy_1"):
        np.testing.assert_allclose(array(many, c), array(one, c), rtol=1e-6, atol=1e-6)
    ramp = np.tile(np.arange(30.0), (30, 1))
    mid = tn.structure_tensor_map(grid({1: ramp}), [(1.0, 1.0)]).where("y = 15 and x = 15").first()
    assert mid.eigv_1_0 == pytest.approx(64.0, rel=1e-6) and mid.eigv_2_0 == pytest.approx(0.0, abs=1e-6)


def test_feature_names():
    assert tn.feature_name("hessian_eigv_1", "intensity_mean", None, None) == "hessian_eigv_1_intensity_mean"
    assert tn.feature_name("hessian_eigv_1", "intensity_mean", 2, 3) == "hessian_eigv_1_intensity_mean_2-3"
    assert tn.feature_name("anisotropy", "intensity_mean", None, 0, "1_2") == "anisotropy_intensity_mean_1_2-0"
    assert tex.prop_name("contrast", 1, 0, 2, 3) == "contrast_1_0" and tex.feature_count(["a"], [1, 2], [0], 3) == 6


@pytest.mark.parametrize("block", [4, 5, 256])
def test_absent_rows_are_no_border(grid, block):
    a = np.random.default_rng(3).integers(0, 99, (12, 12)).astype(float)
    px = grid({1: a}).where("y != 4 and x != 7")
    whole = {(r["y"], r["x"]): r["value"] for r in st.median_filter(px, 3, block=256).collect()}
    got = {(r["y"], r["x"]): r["value"] for r in st.median_filter(px, 3, block=block).collect()}
    assert all(str(got[y, x]) == str(v) for (y, x), v in whole.items() if y != 4 and x != 7)


def test_sparse_labels_end_with_the_pixels(grid):
    from pixelspark.operators.tensors import eroded

    b = np.zeros((12, 12), int)
    b[3:7, 3:7] = 5
    kept = eroded(grid({1: b}, "label", "int").where("label > 0"), 1, grid({1: np.ones((12, 12))}))
    assert sorted((r["y"], r["x"]) for r in kept.collect()) == [(4, 4), (4, 5), (5, 4), (5, 5)]
