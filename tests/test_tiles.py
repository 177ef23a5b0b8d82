"""Operators over cut images against the same on whole arrays: partial sums, sizes, strips, wide windows, texture."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelspark.functions import kernels as K
from pixelspark.operators import background as bg
from pixelspark.operators import measure, shape
from pixelspark.operators import stencil as st
from pixelspark.operators import tensors as tn
from pixelspark.operators import texture as tex
from pixelspark.operators.blocks import image_size, map_blocks
from pixelspark.operators.fused import moments
from pixelspark.plans import screening as plan

RNG = np.random.default_rng(11)


def array(df, name="value", shape_of=None):
    rows = df.select("y", "x", name).collect()
    h, w = shape_of or (max(r[0] for r in rows) + 1, max(r[1] for r in rows) + 1)
    out = np.full((h, w), np.nan)
    for y, x, v in rows:
        out[y, x] = np.nan if v is None else v
    return out


def blobs(h=23, w=31):
    """Labels that lie across tiles: a large one, one of two parts, one on the edge, one that erosion takes away."""
    a = np.zeros((h, w), int)
    a[2:14, 3:20] = 1
    a[6:9, 8:12] = 0
    a[15:21, 4:10] = a[15:21, 20:27] = 2
    a[0, 25:30] = 3
    a[4, 24] = 4
    return a


def by_hand(label, value):
    return {int(k): (value[label == k].mean(), value[label == k].max(), value[label == k].min(), value[label == k].std()) for k in np.unique(label) if k > 0}


@pytest.mark.parametrize("block", [16, 17, 256])
def test_object_features_do_not_depend_on_tiles(grid, block):
    a, b, lab = RNG.integers(0, 500, (23, 31)).astype(float), RNG.normal(100, 9, (23, 31)), blobs()
    px, labels = grid({1: [a, b]}), grid({1: lab}, "label", "int").where("label > 0")
    sigmas = [(1.0, 1.0), (1.5, 1.5)]
    kept = K.erode_min(lab.astype(float), K.disk(1))
    long = tn.hessian_features(px, labels, sigmas, 1, image_size(px), block).collect()
    got = {(r["label"], r["channel"], r["feature"], r["sigma"], r["stat"]): r["value"] for r in long}
    want = {}
    for c, v in enumerate((a, b)):
        for i, field in enumerate(tn.hessian_fields(v, sigmas)):
            for k, stats in by_hand(kept, field).items():
                for name, x in zip(tn.STATS, stats):
                    want[k, c, f"hessian_eigv_{i % 2 + 1}", i // 2, name] = x
    assert got.keys() == want.keys() and 4 not in {k[0] for k in got}
    np.testing.assert_allclose([got[k] for k in want], list(want.values()), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("block", [16, 256])
def test_object_table_is_a_right_merge(grid, block):
    a, lab = RNG.integers(0, 500, (23, 31)).astype(float), blobs()
    px, labels = grid({1: [a, a[::-1]]}), grid({1: lab}, "label", "int").where("label > 0")
    full = plan.object_table(px, labels, [0, 1], sigma=0.6, erosion=1, block=block, extra={
        "median": "intensity_median", "span": lambda v: F.max(v) - F.min(v)})
    rows = {r["label"]: r.asDict() for r in full.collect()}
    assert set(rows) == {1, 2}  # 3 is on the edge, 4 is lost to erosion
    smooth = K.gaussian(a, 0.6, "nearest")
    for k, (mean, high, low, std) in by_hand(lab, smooth).items():
        if k in rows:
            r = rows[k]
            assert r["intensity_mean-0"] == pytest.approx(mean) and r["intensity_std-0"] == pytest.approx(std)
            assert r["median-0"] == pytest.approx(np.median(smooth[lab == k])) and r["span-0"] == pytest.approx(high - low)
            assert r["area"] == (lab == k).sum() and r["perimeter"] > 10
    only = plan.object_table(px, labels, [0, 1], sigma=None, hessian=None, tensor=None, block=block)
    assert {r["label"] for r in only.collect()} == {1, 2, 4}


def test_an_object_table_has_two_python_stages(grid):
    px, labels = grid({1: RNG.normal(size=(12, 12))}), grid({1: np.pad(np.ones((4, 4), int), 4)}, "label", "int")
    plan_text = plan.object_table(px, labels, [0], erosion=1)._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("MapInArrow") == 2 and "ArrowEvalPython" not in plan_text and "FlatMap" not in plan_text


def test_missing_pixels_do_not_count(grid):
    a = RNG.normal(size=(9, 9))
    a[4, 4] = np.nan
    lab = np.zeros((9, 9), int)
    lab[3:6, 3:6] = 7
    found = tn.object_partials(grid({1: a}), grid({1: lab}, "label", "int"), intensity=True, erosion=0, block=4).collect()
    assert [(r["label"], r["n"]) for r in found] == [(7, 8)]
    assert found[0]["mean"] == pytest.approx(np.nanmean(a[3:6, 3:6]))


def test_moments():
    lab = np.array([0, 2, 2, 5, 5, 5, -1])
    v = np.array([9.0, 1.0, 3.0, 4.0, np.nan, 4.0, 9.0])
    label, n, mean, m2, low, high = moments(lab, v)
    assert label.tolist() == [2, 5] and n.tolist() == [2, 2] and mean.tolist() == [2, 4] and m2.tolist() == [2, 0]
    assert low.tolist() == [1, 4] and high.tolist() == [3, 4] and all(len(x) == 0 for x in moments(lab * 0, v))


@pytest.mark.parametrize("block", [5, 8, 256])
def test_size_given_spares_nothing_but_the_pass(grid, block):
    """An image whose last rows hold no pixel: the border is where the size says, at every block size."""
    a = RNG.integers(0, 9, (14, 11)).astype(float)
    px = grid({1: a, 2: a[:7]}).where("not (image_id = 1 and y > 10)")
    size = px.sparkSession.createDataFrame([(1, 14, 11), (2, 7, 11)], "image_id long, height int, width int")
    b = a.copy()
    b[11:] = np.nan
    got = st.median_filter(px, 3, block=block, size_of=size)
    want = K.local(b, np.ones((3, 3), bool), "symmetric", K.LOCAL["median"])
    np.testing.assert_allclose(array(got.where("image_id = 1"), shape_of=a.shape), want)
    np.testing.assert_allclose(array(got.where("image_id = 2")), K.local(a[:7], np.ones((3, 3), bool), "symmetric", K.LOCAL["median"]))


def test_values_behind_the_border_are_left_out(grid):
    px = grid({1: np.ones((6, 6))})
    size = px.sparkSession.createDataFrame([(1, 4, 5)], "image_id long, height int, width int")
    assert array(map_blocks(px, lambda a: a, ["value"], size=size, block=3)).shape == (4, 5)


@pytest.mark.parametrize("mode", ["symmetric", "nearest"])
def test_wide_gaussian_on_strips(grid, mode, monkeypatch):
    a = RNG.normal(size=(50, 70))
    monkeypatch.setattr(st, "STRIP", (36, 9))
    got = array(st.gaussian_filter(grid({1: a}), 8.7, mode))
    np.testing.assert_allclose(got, K.gaussian(a, 8.7, mode), atol=1e-9)


def test_window_copies_are_bounded(monkeypatch):
    a = RNG.integers(0, 50, (40, 37)).astype(float)
    fp = np.ones((7, 7), bool)
    want = K.LOCAL["median"](K.windows(a, fp, "symmetric"))
    monkeypatch.setattr(K, "WINDOW_BYTES", 8 * 49 * 37 * 3)
    np.testing.assert_array_equal(K.local(a, fp, "symmetric", K.LOCAL["median"]), want)


def ball(a, radius):
    out = np.full(a.shape, np.inf)
    for y in range(a.shape[0]):
        for x in range(a.shape[1]):
            g = np.add.outer((np.arange(a.shape[0]) - y) ** 2, (np.arange(a.shape[1]) - x) ** 2)
            near = g <= radius * radius
            out[y, x] = (a[near] + radius - np.sqrt(radius * radius - g[near])).min()
    return out


@pytest.mark.parametrize("radius", [1, 2, 6, 13, 33])
def test_ball_by_cells(radius):
    a = RNG.integers(0, 40, (31, 26)).astype(float)
    want = ball(a, radius)
    np.testing.assert_allclose(K.ball_background(a, radius), want)
    core = (slice(4, 19), slice(3, 26))
    np.testing.assert_allclose(K.ball_background(a, radius, core)[core], want[core])


def test_rolling_ball_by_channel_from_the_workflow(grid):
    a, b = RNG.integers(0, 60, (20, 22)).astype(float), RNG.integers(0, 60, (20, 22)).astype(float)
    back = grid({1: [a, b]}).drop("image_id")
    got = bg.fit_background(back, "simple", radius={0: 3, 1: 5}, white_background={1: True}, smooth={0: 0.7}, max_value=100.0, block=8)
    np.testing.assert_allclose(array(got.where("channel = 0")), K.gaussian(ball(a, 3), 0.7, "symmetric"))
    np.testing.assert_allclose(array(got.where("channel = 1")), 100 - ball(100 - b, 5))


def pairs_by_hand(a, dr, dc):
    return [(a[y, x], a[y + dr, x + dc]) for y in range(a.shape[0]) for x in range(a.shape[1])
            if 0 <= y + dr < a.shape[0] and 0 <= x + dc < a.shape[1]]


@pytest.mark.parametrize("block", [4, 7, 256])
def test_co_occurrence_by_tiles(grid, block):
    a = RNG.integers(-3, 6, (13, 15))
    got = tex.glcm(grid({1: a}, "level", "int").withColumn("channel", F.lit(0)), [1, 3], [0.0, 0.8, 2.4], symmetric=False, normed=False, block=block).collect()
    for di, d in enumerate((1, 3)):
        for ai, t in enumerate((0.0, 0.8, 2.4)):
            want = {}
            for p in pairs_by_hand(a, *tex.offset(d, t)):
                want[p] = want.get(p, 0) + 1
            assert {(r["i"], r["j"]): r["n"] for r in got if (r["d"], r["a"]) == (di, ai)} == want


def matrix_props(i, j):
    """The properties from a dense matrix."""
    n = int(max(i.max(), j.max())) + 1
    p = np.zeros((n, n))
    np.add.at(p, (i, j), 1)
    p = (p + p.T) / (2 * len(i))
    x, y = np.mgrid[:n, :n]
    mu = (p * x).sum()
    var = (p * (x - mu) ** 2).sum()
    return {"contrast": (p * (x - y) ** 2).sum(), "dissimilarity": (p * abs(x - y)).sum(), "homogeneity": (p / (1 + (x - y) ** 2)).sum(), "ASM": (p ** 2).sum(),
            "energy": np.sqrt((p ** 2).sum()), "mean": mu, "variance": var, "std": np.sqrt(var), "entropy": -(p * np.log(np.where(p > 0, p, 1))).sum(),
            "correlation": 1.0 if var < 1e-15 else (p * (x - mu) * (y - mu)).sum() / var}


@pytest.mark.parametrize("strip", [200, 4 << 20])
def test_texture_of_windows(monkeypatch, strip):
    monkeypatch.setattr(tex, "_ROWS_AT_ONCE", strip)
    q = RNG.integers(0, 256, (9, 10)).astype(float)
    q[:4, :4] = 7
    window, step = 5, (-1, 2)
    got = tex.window_props(q, window, [step], tex.PROPS, 256)
    p = np.pad(q, 2, mode="reflect").astype(int)
    for y in range(9):
        for x in range(10):
            ij = np.array(pairs_by_hand(p[y:y + window, x:x + window], *step))
            want = matrix_props(ij[:, 0], ij[:, 1])
            for name, field in zip(tex.PROPS, got):
                assert field[y, x] == pytest.approx(want[name], abs=1e-9), name


@pytest.mark.parametrize("block", [8, 256])
def test_texture_of_objects_by_tiles(grid, block):
    a, lab = RNG.integers(0, 500, (23, 31)).astype(float), blobs()
    px, labels = grid({1: a}), grid({1: lab}, "label", "int").where("label > 0")
    long = tex.haralick_objects(px, labels, ["contrast", "entropy"], window=5, erosion=1, block=block)
    field = tex.haralick_map(px, labels, ["contrast", "entropy"], window=5)
    kept = K.erode_min(lab.astype(float), K.disk(1))
    got = {(r["label"], r["feature"], r["stat"]): r["value"] for r in long.collect()}
    for name in ("contrast", "entropy"):
        f = array(field, name, a.shape)
        want = by_hand(np.where(np.isnan(f), 0, kept), f)
        for k, stats in want.items():
            np.testing.assert_allclose([got[k, name, f"intensity_{s}"] for s in ("mean", "max", "min", "std")], stats, atol=1e-9)
    wide = tex.haralick_table(long, ["contrast", "entropy"], stats=["mean", "std"])
    assert set(wide.columns) >= {"label", "intensity_mean_contrast", "intensity_std_entropy"} and wide.count() == len({k[0] for k in got})


@pytest.mark.parametrize("block", [8, 256])
def test_perimeter_by_tiles(grid, block):
    lab = grid({1: blobs()}, "label", "int")
    got = {r["label"]: r["perimeter"] for r in shape.perimeter(lab, block=block).collect()}
    whole = shape.perimeter_weights(blobs())
    assert got == pytest.approx({k: whole[blobs() == k].sum() for k in (1, 2, 3, 4)})


def test_sigmas_of_the_hessian():
    assert tn.hessian_sigmas() == [(1.0, 1.0)] and tn.hessian_sigmas(1, 2) == [(1.0, 1.0)]
    assert [round(s[0], 9) for s in tn.hessian_sigmas(1, 16)] == [1, 2, 4, 8, 16]
    assert [round(s[0], 9) for s in tn.hessian_sigmas(1, 4, 3)] == [1, 2, 4]
    with pytest.raises(ValueError):
        tn.hessian_sigmas(2, 1)


def test_quality_metrics_of_every_kind(grid):
    a = RNG.integers(0, 50, (12, 12)).astype(float)
    px = grid({1: [a, a * 2]})
    names = ["mean_over_std", "plls", "top_fraction", "bottom_fraction", "low_mean", "laplacian_var"]
    got = plan.quality_metrics(px, names, low=10, high=90)
    assert set(got.columns) == {"image_id", "channel", *names} and got.count() == 2
    row = got.where("channel = 0").first()
    assert row["top_fraction"] == pytest.approx((a >= np.quantile(a, .9)).mean())
    assert row["low_mean"] == pytest.approx(a[a < np.quantile(a, .1)].mean())


def test_extreme_fraction_after_a_median_filter(grid):
    a = RNG.integers(0, 50, (9, 12)).astype(float)
    m = K.local(a, np.ones((3, 3), bool), "nearest", K.LOCAL["median"])
    row = st.extreme_fraction_channel(grid({1: a}), 5, 95, smooth=3, block=4).first()
    assert row["top_fraction"] == pytest.approx((m >= np.quantile(m, .95)).mean())
    cross = np.array([[0, 1, 0], [1, 1, 1], [0, 1, 0]], bool)
    m = K.local(a, cross, "nearest", K.LOCAL["median"])
    row = st.extreme_fraction_channel(grid({1: a}), 5, 95, footprint=cross).first()
    assert row["bottom_fraction"] == pytest.approx((m <= np.quantile(m, .05)).mean())


def test_mean_over_std_of_odd_values(spark):
    rows = [(1, 1.0), (1, 3.0), (1, None), (1, float("nan")), (1, float("inf")), (2, 4.0), (2, 4.0), (3, None)]
    px = spark.createDataFrame([(i, 0, v) for i, v in rows], "image_id long, channel int, value double")
    got = {r["image_id"]: r["mean_over_std"] for r in measure.mean_over_std(px, null_value=-1.0).collect()}
    assert got == {1: 2.0, 2: -1.0, 3: -1.0}
    v = np.array([1.0, 3.0, 5.0])
    got = {r["image_id"]: r["mean_over_std"] for r in measure.mean_over_std(px, inf_value=5.0).collect()}
    assert got[1] == pytest.approx(v.mean() / v.std()) and got[2] is None


def test_label_function_with_positions(spark):
    rows = [(1, 0, 0, 5, 2.0), (1, 3, 1, 5, 9.0), (1, 1, 1, 6, 4.0)]
    px = spark.createDataFrame(rows, "image_id long, y int, x int, label int, value double")
    got = {r["label"]: r["at"] for r in measure.label_measure(px, lambda v, p: F.max_by(p["y"] * 10 + p["x"], v), "at").collect()}
    assert got == {5: 31.0, 6: 11.0}
