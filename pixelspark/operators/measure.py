"""Statistics of whole images, masks, slices, tails and objects."""

from __future__ import annotations

import inspect
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelspark.functions.pixel import minmax, rescale_levels, threshold_mask
from pixelspark.functions.stats import Stat, resolve
from pixelspark.operators.ranking import array_quantile, large_groups, of_groups, percentiles, tile_of, value_counts, whole_values, with_bounds
from pixelspark.schema import IC, ILC, IMG, finite

Stats = Mapping[str, "str | Stat"]


ORDER: Mapping[str, float] = {"median": 0.5, "q25": 0.25, "q75": 0.75}


def _aggs(stats: Stats, value: Column) -> list[Column]:
    return [resolve(s)(value).alias(name) for name, s in stats.items()]


def image_stat(pixels: DataFrame, stats: Stats, keys: Sequence[str] = tuple(IMG),
               value: str = "value") -> DataFrame:
    """Any scalar statistics of all pixels of a group.

    Median and quartiles come from ``ranking.percentiles``; the others share one aggregation.
    """
    order = {name: ORDER[s] for name, s in stats.items() if isinstance(s, str) and s in ORDER}
    plain = {name: s for name, s in stats.items() if name not in order}
    out = pixels.groupBy(*keys).agg(*(_aggs(plain, F.col(value)) or [F.count(F.lit(1)).alias("_n")]))
    if not order:
        return out
    key = [f"_key_{i}" for i in range(len(keys))]
    found = percentiles(pixels, keys, value, order).select(*[F.col(k).alias(n) for k, n in zip(keys, key)], *order)
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, key)]
    return out.join(found, same, "left").select(*keys, *stats)


def mean_over_std(pixels: DataFrame, keys: Sequence[str] = tuple(IC), inf_value: float | None = None,
                  null_value: float | None = None, out: str = "mean_over_std") -> DataFrame:
    """Mean divided by population standard deviation of the values that are numbers.

    NaN and NULL do not count; ``inf_value`` stands for +-Inf (left out where None). A group whose deviation is 0 or that has no
    value gets ``null_value``.
    """
    ratio = resolve("mean_over_std")(finite(F.col("value").cast("double"), inf_value))
    return pixels.groupBy(*keys).agg(F.coalesce(ratio, F.lit(null_value).cast("double")).alias(out))


def mask_join(pixels: DataFrame, mask: DataFrame) -> DataFrame:
    """Pixels with the label of a mask; a mask without channel serves every channel."""
    on = [c for c in ("image_id", "channel", "y", "x") if c in mask.columns]
    return pixels.join(mask, on)


def mask_violations(pixels: DataFrame, mask: DataFrame) -> DataFrame:
    """Images whose dense mask has negative labels or another shape than the pixels."""
    extent = [(F.max(c) + 1).alias(c) for c in ("y", "x")]
    a = pixels.groupBy(*IMG).agg(*[e.alias(f"{c}_px") for e, c in zip(extent, ("y", "x"))])
    b = mask.groupBy(*IMG).agg(*[e.alias(f"{c}_mask") for e, c in zip(extent, ("y", "x"))],
                               F.min("label").alias("lowest"))
    bad = (F.col("lowest") < 0) | ~F.col("y_px").eqNullSafe(F.col("y_mask")) \
        | ~F.col("x_px").eqNullSafe(F.col("x_mask"))
    return a.join(b, IMG, "left").where(bad)


def masked_stat(pixels: DataFrame, mask: DataFrame, stats: Stats,
                keys: Sequence[str] = tuple(IMG)) -> DataFrame:
    """Statistics over pixels where the mask is positive.

    With ``keys`` holding a slice axis (channel, y or x) one value per slice; a mask without
    that axis is applied to every slice.
    """
    return image_stat(mask_join(pixels, mask.where("label > 0")), stats, keys)


def axis_stat(pixels: DataFrame, axis: str, stats: Stats, mask: DataFrame | None = None) -> DataFrame:
    """One value per slice along ``axis``."""
    keys = [*IMG, axis]
    return masked_stat(pixels, mask, stats, keys) if mask is not None else image_stat(pixels, stats, keys)


def agg_axis_stat(pixels: DataFrame, axis: str, inner: str | Stat, outer: Stats,
                  mask: DataFrame | None = None) -> DataFrame:
    """Aggregate the per-slice statistic once more per image."""
    per_slice = axis_stat(pixels, axis, {"_inner": inner}, mask)
    return image_stat(per_slice, outer, IMG, "_inner")


def normalized_skew(pixels: DataFrame, keys: Sequence[str] = tuple(IC), out: str = "skew") -> DataFrame:
    """Skewness after min-max scaling.

    Skewness does not change under a positive linear map and a constant group is NULL either
    way, so the scaling pass is left out.
    """
    return image_stat(pixels, {out: "skew"}, keys)


def minmax_normalize(pixels: DataFrame, keys: Sequence[str] = tuple(IC)) -> DataFrame:
    """(v-min)/(max-min) per group; constant groups stay as they are."""
    range_ = pixels.groupBy(*keys).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    return (with_bounds(pixels, range_, keys, tile_of("y", "x"))
            .withColumn("value", minmax(F.col("value"), F.col("_lo"), F.col("_hi")))
            .drop("_lo", "_hi"))


def quantize(pixels: DataFrame, keys: Sequence[str] = tuple(IC), levels: int = 8,
             p_low: float = 0.01, p_high: float = 0.99, bottom: int = 0, out: str = "level") -> DataFrame:
    """Grey level per pixel after clipping to two percentiles of its group."""
    bounds = percentiles(pixels, keys, "value", {"_lo": p_low, "_hi": p_high})
    return (with_bounds(pixels, bounds, keys, tile_of("y", "x"))
            .withColumn(out, rescale_levels(F.col("value"), F.col("_lo"), F.col("_hi"), levels, bottom))
            .drop("_lo", "_hi"))


def _check_band(low: float, high: float) -> None:
    if not 0.0 <= low < high <= 100.0:
        raise ValueError("percentiles must satisfy 0 <= low < high <= 100")


def extreme_fraction(pixels: DataFrame, low: float = 1.0, high: float = 99.0,
                     keys: Sequence[str] = tuple(IC)) -> DataFrame:
    """Share of pixels at or below the low and at or above the high percentile.

    Works on the distinct values of a group and their counts. A group without a valid
    pixel keeps a row of NULLs.
    """
    _check_band(low, high)
    counts = value_counts(pixels, keys)
    bounds = percentiles(counts, keys, "value", {"low_threshold": low / 100, "high_threshold": high / 100},
                         weight="n")
    n = F.col("n")
    part = (with_bounds(counts, bounds, keys, F.col("value")).groupBy(*keys).agg(
        (F.sum(F.when(F.col("value") <= F.col("low_threshold"), n).otherwise(0)) / F.sum(n)).alias("bottom_fraction"),
        (F.sum(F.when(F.col("value") >= F.col("high_threshold"), n).otherwise(0)) / F.sum(n)).alias("top_fraction"),
        F.first("low_threshold").alias("low_threshold"), F.first("high_threshold").alias("high_threshold"),
        F.sum(n).alias("n_valid")))
    return pixels.select(*keys).distinct().join(part, list(keys), "left").fillna(0, ["n_valid"])


def counted_stat(counts: DataFrame, keys: Sequence[str], stat: str, out: str,
                 where: Column | None = None) -> DataFrame:
    """mean, median, mode, max or min from distinct values and counts; mode ties give the smallest."""
    if where is not None:
        counts = counts.where(where)
    v, n = F.col("value"), F.col("n")
    if stat == "median":
        return percentiles(counts, keys, "value", {out: 0.5}, weight="n")
    pick = {"mean": F.sum(v * n) / F.sum(n), "mode": F.max_by(v, F.struct(n, -v)),
            "max": F.max(v), "min": F.min(v)}
    if stat not in pick:
        raise ValueError("stat must be mean, median, mode, max or min")
    return counts.groupBy(*keys).agg(pick[stat].alias(out))


def pixel_stat(pixels: DataFrame, mask: DataFrame, stat: str = "mean", out: str = "stat",
               keys: Sequence[str] = tuple(IMG)) -> DataFrame:
    """Statistic over pixels whose mask is zero or more."""
    counts = value_counts(mask_join(pixels, mask.where("label >= 0")), keys)
    return counted_stat(counts, keys, stat, out)


def low_high_tail(pixels: DataFrame, low: float, high: float, stat: str = "mean",
                  keys: Sequence[str] = tuple(IC)) -> DataFrame:
    """Statistic strictly below the low and strictly above the high percentile; empty tail NULL."""
    if not keys:
        return tails_spread(pixels, low, high, stat, keys)
    many = large_groups(pixels.where("value is not null"), keys)
    return tails_whole(of_groups(pixels, many, False), low, high, stat, keys).unionByName(
        tails_spread(of_groups(pixels, many, True), low, high, stat, keys))


def tails_whole(pixels: DataFrame, low: float, high: float, stat: str, keys: Sequence[str]) -> DataFrame:
    """``low_high_tail`` of groups of at most ``ranking.GROUP_ROWS`` rows, each put in order where its rows meet."""
    if stat == "mode":
        return tails_spread(pixels, low, high, stat, keys)
    _check_band(low, high)
    v, t = F.col("_v"), F.col("_t")
    pick = {"mean": F.try_divide(F.aggregate(t, F.lit(0.0), lambda a, x: a + x.cast("double")), F.size(t)), "median": array_quantile(t, 0.5),
            "max": F.try_element_at(t, F.lit(-1)), "min": F.try_element_at(t, F.lit(1))}
    if stat not in pick:
        raise ValueError("stat must be mean, median, mode, max or min")
    rows = whole_values(pixels, keys, "value", "_v").withColumns({"_lo": array_quantile(v, low / 100), "_hi": array_quantile(v, high / 100)})
    named = reduce(and_, [F.col(k).isNotNull() for k in keys])  # a group without a name keeps a row of NULLs
    for side, part in (("low", F.filter(v, lambda x: x < F.col("_lo"))), ("high", F.filter(v, lambda x: x > F.col("_hi")))):
        rows = rows.withColumn("_t", part).withColumn(f"{side}_{stat}", F.when(named, pick[stat]))
    return rows.select(*keys, f"low_{stat}", f"high_{stat}")


def tails_spread(pixels: DataFrame, low: float, high: float, stat: str, keys: Sequence[str]) -> DataFrame:
    """``low_high_tail`` from the distinct values of a group and their counts, groups of any size."""
    _check_band(low, high)
    counts = value_counts(pixels, keys)
    bounds = percentiles(counts, keys, "value", {"_lo": low / 100, "_hi": high / 100}, weight="n")
    counts = with_bounds(counts, bounds, keys, F.col("value"))
    side = F.when(F.col("value") < F.col("_lo"), "low").when(F.col("value") > F.col("_hi"), "high")
    tails = counted_stat(counts.withColumn("_side", side), [*keys, "_side"], stat, "_s",
                         F.col("_side").isNotNull())
    wide = tails.groupBy(*keys).agg(*[F.max(F.when(F.col("_side") == s, F.col("_s"))).alias(f"{s}_{stat}")
                                      for s in ("low", "high")])
    return bounds.select(*keys).join(wide, list(keys), "left")


def tail_stat(pixels: DataFrame, perc: float, stat: str = "mean", below: bool = True,
              keys: Sequence[str] = tuple(IC)) -> DataFrame:
    """Statistic of the pixels strictly below (or above) one percentile; empty tail NULL."""
    if not 0 <= perc <= 100:
        raise ValueError("perc must be in [0, 100]")
    counts = value_counts(pixels, keys)
    bound = percentiles(counts, keys, "value", {"threshold": perc / 100}, weight="n")
    side = F.col("value") < F.col("threshold") if below else F.col("value") > F.col("threshold")
    part = counted_stat(with_bounds(counts, bound, keys, F.col("value")), keys, stat, stat, side)
    return bound.join(part, list(keys), "left")


def label_pixels(pixels: DataFrame, labels: DataFrame) -> DataFrame:
    """Region pixels of each channel; the sparse labels drive the join."""
    return labels.join(pixels, [*IMG, "y", "x"])


OBJECT_STATS: Mapping[str, str] = {"intensity_mean": "mean", "intensity_min": "min",
                                   "intensity_max": "max", "intensity_std": "std",
                                   "intensity_sum": "sum", "intensity_skew": "skew"}


_ORDER_STATS: Mapping[str, float] = {"intensity_median": 0.5, "intensity_q25": 0.25, "intensity_q75": 0.75}


def object_intensity(objects: DataFrame, keys: Sequence[str] = tuple(ILC), value: str = "value") -> DataFrame:
    """Per-object mean, extremes, deviation, sum, skewness, median, quartiles and MAD.

    The pixels are joined once and kept (on disk where memory ends, until the session's cache is cleared): they are counted, and
    objects of at most ``ranking.GROUP_ROWS`` pixels are then put in order where their pixels meet, which gives all of their
    statistics. Larger ones take the spread way. An object whose name has a NULL is left out.
    """
    rows = objects.select(*keys, F.col(value).alias("value")).where(
        reduce(and_, [F.col(c).isNotNull() for c in ("value", *keys)])).persist(StorageLevel.MEMORY_AND_DISK)
    if not keys:
        return _intensity_spread(rows, keys)
    many = large_groups(rows, keys)
    return _intensity_whole(of_groups(rows, many, False), keys).unionByName(_intensity_spread(of_groups(rows, many, True), keys))


def _intensity_whole(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    v, mean, n = F.col("_v"), F.col("intensity_mean"), F.size("_v")
    out = whole_values(rows, keys, "value", "_v", F.sum("value").alias("intensity_sum"))
    out = out.withColumns({"intensity_min": F.get(v, F.lit(0)), "intensity_max": F.get(v, n - 1), "intensity_mean": F.col("intensity_sum") / n,
                           **{name: array_quantile(v, q) for name, q in _ORDER_STATS.items()}})
    out = out.withColumns({"_m2": F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n,
                           "_m3": F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean) * (x - mean)) / n,
                           "_away": F.sort_array(F.transform(v, lambda x: F.abs(x - F.col("intensity_median"))))})
    return _deviation(out.withColumn("intensity_mad", array_quantile(F.col("_away"), 0.5)).drop("_v", "_away"), keys)


def _deviation(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deviation and skewness from the central moments; all columns in their order."""
    varies = F.col("intensity_max") > F.col("intensity_min")
    return df.select(*keys, "intensity_sum", "intensity_min", "intensity_max", *_ORDER_STATS, "intensity_mean", "intensity_mad",
                     F.when(varies, F.sqrt("_m2")).otherwise(0.0).alias("intensity_std"),
                     F.when(varies, F.try_divide(F.col("_m3"), F.pow("_m2", F.lit(1.5)))).alias("intensity_skew"))


def _intensity_spread(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """From the distinct values of an object and their counts, which are kept for the second pass, over the central moments and the
    deviation from the median."""
    counts = value_counts(rows, keys).persist(StorageLevel.MEMORY_AND_DISK)
    v, n = F.col("value"), F.col("n")
    first = counts.groupBy(*keys).agg(F.sum(n).alias("_n"), F.sum(v * n).alias("intensity_sum"),
                                      F.min(v).alias("intensity_min"), F.max(v).alias("intensity_max"))
    first = first.join(percentiles(counts, keys, "value", _ORDER_STATS, weight="n"), list(keys))
    first = first.withColumn("intensity_mean", F.col("intensity_sum") / F.col("_n")).drop("_n")
    away = v - F.col("intensity_mean")
    dev = with_bounds(counts, first.select(*keys, "intensity_mean", "intensity_median"), keys, v).withColumns(
        {"_2": away * away * n, "_3": away * away * away * n, "value": F.abs(v - F.col("intensity_median"))}).persist(StorageLevel.MEMORY_AND_DISK)
    second = dev.groupBy(*keys).agg((F.sum("_2") / F.sum(n)).alias("_m2"), (F.sum("_3") / F.sum(n)).alias("_m3"))
    second = second.join(percentiles(dev, keys, "value", {"intensity_mad": 0.5}, weight="n"), list(keys))
    return _deviation(first.join(second, list(keys)), keys)


def quantile_intensity(objects: DataFrame, q: float, out: str, keys: Sequence[str] = tuple(ILC), accuracy: int | None = None) -> DataFrame:
    """Linear-interpolated quantile per object; ``accuracy`` opts into the approximate one."""
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must lie in [0, 1]")
    if accuracy is not None:
        return objects.groupBy(*keys).agg(F.percentile_approx("value", q, accuracy).alias(out))
    return percentiles(objects, keys, "value", {out: q})


def label_measure(objects: DataFrame, stat: str | Stat, out: str, index: DataFrame | None = None,
                  default: float | None = None, dtype: str = "double",
                  keys: Sequence[str] = ("image_id", "label"), value: str = "value") -> DataFrame:
    """A caller's aggregate per label; labels of ``index`` without pixels get ``default``.

    ``stat`` is a name, or a function from the value column to an aggregate. One with a second parameter also gets the
    position of each pixel, a struct of y and x, if ``objects`` has these columns.
    """
    if isinstance(stat, str) and stat in ORDER:
        got = image_stat(objects, {out: stat}, keys, value)
        return _with_default(got, index, out, default, dtype, keys)
    if not isinstance(stat, str) and len(inspect.signature(stat).parameters) > 1:
        made = stat(F.col(value), F.struct("y", "x"))
    else:
        made = resolve(stat)(F.col(value))
    return _with_default(objects.groupBy(*keys).agg(made.alias(out)), index, out, default, dtype, keys)


def _with_default(got: DataFrame, index: DataFrame | None, out: str, default: float | None, dtype: str, keys: Sequence[str]) -> DataFrame:
    if index is not None:
        got = index.join(got, list(keys), "left")
    return got.withColumn(out, F.coalesce(F.col(out), F.lit(default)).cast(dtype))


def values_per_label(objects: DataFrame, keys: Sequence[str] = ("image_id", "label")) -> DataFrame:
    """The values of each label, label 0 included, as (label, value, n) rows.

    A list per label would pull a whole label into one row; the counted rows hold the same
    multiset at any size.
    """
    return value_counts(objects, keys)


def threshold_image(pixels: DataFrame, threshold: float = 4000.0) -> DataFrame:
    """Placeholder segmentation: label 1 where the value exceeds the threshold."""
    return pixels.withColumn("label", threshold_mask(F.col("value"), threshold)).drop("value")


def merge_channels(pixels: DataFrame, channels: Sequence[int]) -> DataFrame:
    """Mean of the listed channels per pixel."""
    return (pixels.where(F.col("channel").isin(*channels))
            .groupBy(*IMG, "y", "x").agg(F.avg("value").alias("value")))


