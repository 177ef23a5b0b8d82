"""Small images go through filters together, and small groups are put in order where they meet; results stay."""

import numpy as np
import pytest

from pixelspark.functions import kernels as K
from pixelspark.operators import measure, outline, ranking, shape, tensors
from pixelspark.operators import stencil as st


def _rows(df):
    return sorted((tuple(None if v is None else "nan" if v != v else round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.fixture
def images(spark):
    """Images of two sizes with two channels, an absent pixel, NULL, NaN, a NULL name and repeated rows."""
    rng = np.random.default_rng(8)
    rows = [(k, c, y, x, float(rng.integers(0, 9))) for k in (*range(6), None) for c in range(2) for y in range(5) for x in range(4 + (k or 0) % 2)]
    rows[3], rows[17] = (*rows[3][:4], None), (*rows[17][:4], float("nan"))
    del rows[40]
    return spark.createDataFrame([*rows, *rows[100:110]], "image_id long, channel int, y int, x int, value double")


def test_kernels_of_a_stack_are_those_of_its_tiles():
    a, fp = np.random.default_rng(7).normal(size=(30, 6, 5)), np.ones((3, 3), bool)
    for f in (lambda a: K.local(a, fp, "nearest", K.LOCAL["median"]), lambda a: K.gaussian(a, 0.6, "nearest"), lambda a: K.erode_min(a, K.disk(1)),
              lambda a: K.gradient(a, -2), lambda a: K.gradient(a, -1)):
        np.testing.assert_array_equal(f(a), np.stack([f(t) for t in a]))


def test_small_images_are_filtered_together(spark, images):
    calls = spark.sparkContext.accumulator(0)

    def median(w):
        calls.add(1)
        return np.median(w, axis=-1)

    alone = _rows(st.local_map(images, median, 3, mode="nearest"))
    one_by_one = calls.value
    K_median, K.LOCAL["median"] = K.LOCAL["median"], median
    try:
        together = _rows(st.median_filter(images, 3, mode="nearest"))
    finally:
        K.LOCAL["median"] = K_median
    assert alone == together and len(alone) == 14 * 20 + 6 * 5
    assert calls.value - one_by_one < one_by_one


@pytest.mark.parametrize("stat", ["mean", "median"])
def test_tails_of_whole_and_of_spread_groups(images, monkeypatch, stat):
    run = lambda: _rows(measure.low_high_tail(images, 10, 60, stat)) + _rows(st.low_high_tail_channel(images, 10, 60, stat, smooth=3))
    whole = run()
    assert len(whole) == 28
    monkeypatch.setattr(ranking, "GROUP_ROWS", 20)
    mixed = run()
    monkeypatch.setattr(ranking, "GROUP_ROWS", -1)
    assert whole == mixed == run()


def test_small_slices_take_one_exchange_for_their_tails(images):
    plan = measure.tails_whole(images, 10, 90, "mean", ["image_id", "channel"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_intensity_of_whole_and_of_spread_objects(spark, images, monkeypatch):
    px = images.withColumnRenamed("image_id", "label").selectExpr("1L AS image_id", "label", "channel", "value")
    px = px.unionByName(spark.createDataFrame([(2, 1, 0, 4.0)] * 3 + [(2, 2, 0, None)], "image_id long, label long, channel int, value double"))
    run = lambda: _rows(measure.object_intensity(px))
    whole = run()
    assert len(whole) == 13
    monkeypatch.setattr(ranking, "GROUP_ROWS", 20)
    assert whole == run()
    plan = measure._intensity_whole(px, ["image_id", "label", "channel"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_tensors_and_perimeters_of_a_stack_are_those_of_its_tiles():
    rng = np.random.default_rng(5)
    a, labels = rng.normal(size=(20, 7, 6)), rng.integers(0, 3, (20, 7, 6)).astype(float)
    for f, b in ((lambda a: np.stack(tensors.hessian_fields(a, [(1.0, 1.0)])), a), (lambda a: np.stack(tensors.tensor_fields(a, [(1.0, 1.0)])), a),
                 (lambda a: shape.perimeter_weights(a)[None], labels)):
        np.testing.assert_array_equal(f(b), np.stack([f(t) for t in b], 1))


def test_items_of_a_stack_are_those_of_its_tiles():
    rng = np.random.default_rng(6)
    labels = rng.integers(0, 3, (60, 9, 8)).astype(float)
    labels[0], labels[1] = 0, 0
    labels[1, 1:6, 1:6], labels[1, 2:5, 2:5], labels[1, 3, 3] = 1, 0, 2
    got = np.stack(outline.stack_items(labels), 1)
    want = np.concatenate([np.stack(outline.label_items(t, 0, 0), 1) + [[k * outline.OBJECT, 0, 0, 0, 0, 0]] for k, t in enumerate(labels)])
    want = want[np.isin(want[:, 1], (outline.CLOSED, outline.VERTEX))]
    assert sorted(map(tuple, got.tolist())) == sorted(map(tuple, want.tolist()))
    assert got[(got[:, 0] == outline.OBJECT + 1) & (got[:, 1] == outline.CLOSED), 5] == 9


def test_hulls_of_many_objects_are_those_of_each():
    rng = np.random.default_rng(9)
    of = np.sort(rng.integers(0, 40, 2000))
    y, x = rng.integers(-1, 60, 2000), rng.integers(-1, 60, 2000)
    t = np.linspace(0, 2 * np.pi, 4000)
    of, y, x = np.append(of, np.full(4000, 99)), np.append(y, np.rint(9000 * np.sin(t)).astype(int)), np.append(x, np.rint(9000 * np.cos(t)).astype(int))
    got = outline.hulls(of, y, x)
    for k in np.unique(of):
        p, q = y[of == k] / 2, x[of == k] / 2
        far = max(((p - a) ** 2 + (q - b) ** 2).max() for a, b in zip(p, q)) ** 0.5
        assert got[int(k)] == outline.hulls(of[of == k], y[of == k], x[of == k])[int(k)] and abs(got[int(k)][1] - far) < 1e-9
    square = outline.hulls(np.zeros(4, int), np.array([0, 0, 6, 6]), np.array([0, 6, 0, 6]))
    assert square == {0: (16, 18 ** 0.5)}


def test_objects_of_small_images_do_not_depend_on_the_tiles(images):
    labels = images.where("channel = 0 and value >= 2 and image_id is not null").selectExpr("image_id", "y", "x", "cast(1 + x div 3 AS int) AS label").distinct()
    run = lambda block: _rows(tensors.object_partials(images, labels, hessian=[(0.5, 0.5)], tensor=[(0.5, 0.5)], smooth=0.3, intensity=True, erosion=0,
                                                      perimeter=shape.perimeter_weights, block=block, outlines=True))
    assert run(256) == run(4)
