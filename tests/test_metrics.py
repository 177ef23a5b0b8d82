"""Hand grids and edge cases of statistics, quality metrics and order statistics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelspark.operators import measure, qc
from pixelspark.operators.ranking import numbered, order_code, percentiles, random_numbered, value_ranks
from pixelspark.schema import IC, finite


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_plain_statistics(grid):
    got = one(measure.image_stat(grid({1: [[1, 2, 2, 10]]}), {s: s for s in ("median", "skew", "std", "sum", "mean_over_std")}))
    assert got["median"] == 2 and got["sum"] == 15
    assert got["skew"] == pytest.approx(1.10997, abs=1e-5) and got["std"] == pytest.approx(3.63146, abs=1e-5)


def test_constant_image(grid):
    px = grid({1: np.full((4, 4), 7)})
    got = one(measure.image_stat(px, {"m": "mean_over_std", "s": "skew"}))
    assert got["m"] is None and got["s"] is None
    frac = one(measure.extreme_fraction(px, 1, 99))
    assert (frac.bottom_fraction, frac.top_fraction, frac.low_threshold, frac.high_threshold) == (1.0, 1.0, 7.0, 7.0)
    assert one(qc.plls(px)).slope is None
    assert {r.level for r in measure.quantize(px).collect()} == {0}
    assert {r.value for r in measure.minmax_normalize(px).collect()} == {7.0}


def test_object_intensity(grid):
    a = np.array([[1, 2, 2, 10, 0.1, 0.1, 0.1]])
    px = grid({1: a}).withColumn("label", F.when(F.col("x") < 4, 1).otherwise(2))
    got = {r.label: r for r in measure.object_intensity(px).collect()}
    assert (got[1].intensity_median, got[1].intensity_mad, got[1].intensity_q25, got[1].intensity_sum) == (2, 0.5, 1.75, 15)
    assert got[1].intensity_skew == pytest.approx(1.10997, abs=1e-5) and got[1].intensity_std == pytest.approx(3.63146, abs=1e-5)
    assert (got[2].intensity_std, got[2].intensity_skew, got[2].intensity_mad) == (0.0, None, 0.0)


def test_mode_tie_takes_smallest(grid):
    px, mask = grid({1: [[5, 3, 3, 5, 9]]}), grid({1: [[0, 0, 0, 0, -1]]}, "label", "int")
    assert one(measure.pixel_stat(px, mask, "mode")).stat == 3.0
    assert one(measure.pixel_stat(px, mask, "max")).stat == 5.0


def test_linear_ramp_fraction(grid):
    got = one(measure.extreme_fraction(grid({1: np.linspace(0, 100, 1000).reshape(20, 50)}), 1, 99))
    assert got.bottom_fraction == pytest.approx(0.01) and got.top_fraction == pytest.approx(0.01)


def test_slice_without_values_is_null(grid):
    px = grid({1: [np.arange(9).reshape(3, 3), np.full((3, 3), np.nan)]})
    rows = {r.channel: r for r in measure.extreme_fraction(px).collect()}
    assert rows[1].bottom_fraction is None and rows[1].n_valid == 0 and rows[0].n_valid == 9


def test_single_pixel(grid):
    got = one(measure.extreme_fraction(grid({1: [[5]]})))
    assert (got.bottom_fraction, got.top_fraction) == (1.0, 1.0)


@pytest.mark.parametrize("band", [(50, 50), (60, 40), (-1, 50), (10, 101)])
def test_bad_percentiles(grid, band):
    with pytest.raises(ValueError):
        measure.extreme_fraction(grid({1: [[1]]}), *band)


def test_empty_tail_is_null(grid):
    got = one(measure.low_high_tail(grid({1: [[4, 4, 4]]}), 10, 90))
    assert got.low_mean is None and got.high_mean is None


def test_nan_and_inf_become_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (2.0,)], "v double").select(finite(F.col("v")).alias("v"))
    assert sorted((r.v is None, r.v) for r in df.collect()) [0] == (False, 2.0)
    assert df.where("v is null").count() == 2


def _plls(a):
    p = np.abs(np.fft.fftshift(np.fft.fft2(a))) ** 2
    h, w = a.shape
    y, x = np.ogrid[:h, :w]
    r = np.sqrt((x - w // 2) ** 2 + (y - h // 2) ** 2).astype(int)
    mean = np.bincount(r.ravel(), p.ravel()) / np.maximum(np.bincount(r.ravel()), 1)
    ok = (mean > 0) & (np.arange(mean.size) > 0)
    return np.polyfit(np.log(np.arange(mean.size)[ok]), np.log(mean[ok]), 1)


@pytest.mark.parametrize("shape", [(16, 16), (9, 9), (8, 13), (15, 6), (1, 32), (32, 1)])
def test_plls_matches_two_dimensional_transform(grid, shape):
    a = np.random.default_rng(3).normal(size=shape)
    got = one(qc.plls(grid({1: a})))
    assert [got.slope, got.intercept] == pytest.approx(list(_plls(a)), abs=1e-8)


def test_plls_noise_is_flat_and_slices_independent(grid):
    rng = np.random.default_rng(1)
    noise, other = rng.normal(size=(48, 48)), rng.normal(size=(48, 48)).cumsum(0)
    both = {r.channel: r.slope for r in qc.plls(grid({1: [noise, other]})).collect()}
    assert -0.5 < both[0] < 0.5
    assert both[0] == pytest.approx(one(qc.plls(grid({1: noise}))).slope)


def test_plls_needs_two_radii_and_values(grid):
    assert one(qc.plls(grid({1: [[3]]}))).slope is None
    a = np.random.default_rng(0).normal(size=(6, 6))
    a[2, 3] = np.nan
    assert one(qc.plls(grid({1: a}))).slope is None


def test_flag_bounds_are_inclusive_and_null_never_flags(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, None)], "image_id int, v double")
    flags = {r.image_id: r.flag for r in qc.flag_rows(df, ["v"], [3.0], [1.0]).collect()}
    assert flags == {1: 1, 2: 0, 3: 1, 4: 0}
    assert {r.flag for r in qc.flag_rows(df, ["v"], [3.0], [1.0], strict=True).collect()} == {0}
    assert {r.flag for r in qc.flag_rows(df, ["v"], [None], [float("nan")]).collect()} == {0}
    with pytest.raises(ValueError):
        qc.flag_rows(df, ["v"], [1.0, 2.0], [1.0])


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, half of them ties; others are small."""
    return spark.range(60_000).select(
        F.when(F.col("id") % 20 < 13, 0).otherwise(F.col("id") % 997).alias("g"),
        F.when(F.col("id") % 2 == 0, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(10_000)) / 7.0).alias("v"))


def test_distributed_percentiles_equal_numpy(skewed):
    qs = {"a": 0.0, "b": 0.013, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {r.g: [r[k] for k in qs] for r in percentiles(skewed, ["g"], "v", qs).collect()}
    for g, part in skewed.toPandas().groupby("g"):
        assert got[g] == pytest.approx(list(np.quantile(part["v"], list(qs.values()))))


def test_percentiles_of_odd_values(spark):
    """Signs, zeros, tiny, huge and infinite values, NaN above all, NULL groups, whole numbers, and weights."""
    inf, tiny = float("inf"), 5e-324
    groups = {"a": [-inf, -1e300, -2.0, -1.0, -tiny, 0.0, -0.0, tiny, 1.0, 1.0 + 2**-40, 2.0, 1e300, inf], "b": [1.0], "c": [3.0, float("nan")], None: [1.0, 2.0, 4.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in [*vs, None]], "g string, v double")
    got = {r["g"]: r for r in percentiles(df, ["g"], "v", {"low": 0.0, "mid": 0.5, "high": 1.0, "q": 0.25}).collect()}
    assert set(got) == set(groups)
    assert (got["a"].low, got["a"].mid, got["a"].high, got["a"].q) == (-inf, 0.0, inf, -1.0)
    assert (got["b"].low, got["b"].q) == (1.0, 1.0) and got["c"].low == 3.0 and got["c"].high != got["c"].high
    assert (got[None].mid, got[None].q) == (2.0, 1.5)
    whole = spark.createDataFrame([(1, 10, 3), (1, 20, 1)], "g int, v long, w long")
    assert one(percentiles(whole, ["g"], "v", {"m": 0.5, "t": 1.0}, weight="w")) == (1, 10.0, 20.0)


def test_order_code_never_falls(spark):
    r = np.random.default_rng(0)
    v = np.sort(np.concatenate([r.normal(size=2000) * 10.0 ** r.integers(-300, 300, 2000), np.nextafter(2.0 ** np.arange(-20, 20), 0), 2.0 ** np.arange(-20, 20)]))
    code = [x[0] for x in spark.createDataFrame([(float(x),) for x in v], "v double").coalesce(1).select(order_code(F.col("v"))).collect()]
    assert (np.diff(code) >= 0).all() and len(set(code)) > 1500


def test_ranks_spread_the_hot_group(skewed):
    ranks = value_ranks(skewed, ["g"], "v")
    assert one(ranks.where("g = 0").agg(F.sum("n").alias("n"), F.max("below_total").alias("t"))) == (
        skewed.where("g = 0").count(),) * 2


def test_numbering_is_a_permutation(skewed):
    rows = numbered(skewed.withColumn("k", F.monotonically_increasing_id()), ["g"], ["v", "k"],
                    F.floor(F.col("v") / 100), "rn")
    bad = rows.groupBy("g").agg(F.countDistinct("rn").alias("d"), F.max("rn").alias("m"), F.count("rn").alias("c"),
                                F.max("rn_total").alias("t")).where("d <> m or d <> c or d <> t")
    assert bad.count() == 0


def test_random_numbering_is_stable_under_partitioning(spark):
    df = spark.range(1000).toDF("k")
    a = random_numbered(df.repartition(3), ["k"], 7).select("k", "rn")
    b = random_numbered(df.repartition(11), ["k"], 7).select("k", "rn")
    assert a.exceptAll(b).count() == 0
    assert random_numbered(df, ["k"], 8).select("k", "rn").exceptAll(a).count() > 900


def test_distribution_and_extremes(spark):
    df = spark.createDataFrame([(1, 0, 5.0), (2, 0, 1.0), (3, 0, 5.0), (4, 0, None)], "image_id int, channel int, v double")
    got = one(qc.qc_extremes(df, "v"))
    assert (got.lowest_image, got.highest_image, got.highest) == (2, 1, 5.0)
    d = one(qc.qc_distribution(df, "v", ["channel"]))
    assert (d.n, d.median, d.q1) == (3, 5.0, 3.0)


def test_metrics_long_roundtrip(grid):
    wide = measure.image_stat(grid({1: [[1, 2]], 2: [[3, 5]]}), {"mean": "mean", "max": "max"}, IC)
    assert qc.metrics_long(wide, ["mean", "max"]).count() == 4
