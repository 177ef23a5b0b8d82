"""Image quality: flags, bands, extremes, distributions, sharpness and spectrum slope."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelspark.functions import kernels as K
from pixelspark.operators.blocks import BLOCK, map_blocks
from pixelspark.operators.ranking import percentiles
from pixelspark.schema import IC, IMG


def violates(value: Column, high_pass: Column, low_pass: Column, strict: bool = False) -> Column:
    """True at or below the high-pass or at or above the low-pass bound; NULLs never violate."""
    if strict:
        return F.coalesce(value < high_pass, F.lit(False)) | F.coalesce(value > low_pass, F.lit(False))
    return F.coalesce(value <= high_pass, F.lit(False)) | F.coalesce(value >= low_pass, F.lit(False))


def flag_rows(df: DataFrame, columns: Sequence[str], low_pass: Sequence[float | None],
              high_pass: Sequence[float | None], out: str = "flag", flag_value: object = 1,
              ok_value: object = 0, strict: bool = False) -> DataFrame:
    """Flag rows where any column leaves its pass band."""
    if not len(columns) == len(low_pass) == len(high_pass):
        raise ValueError("one low-pass and one high-pass value per column are needed")

    def bound(v: float | None) -> Column:
        return F.lit(None if v is None or v != v else float(v)).cast("double")

    tests = [violates(F.col(f"`{c}`"), bound(hi), bound(lo), strict)
             for c, lo, hi in zip(columns, low_pass, high_pass)]
    flagged = reduce(lambda a, b: a | b, tests, F.lit(False))
    return df.withColumn(out, F.when(flagged, flag_value).otherwise(ok_value))


def flag_long(metrics: DataFrame, thresholds: DataFrame, keys: Sequence[str] = tuple(IMG),
              on: Sequence[str] = ("channel", "metric"), out: str = "flag") -> DataFrame:
    """Flag per group from long metrics and a (channel, metric, high_pass, low_pass) table."""
    hit = violates(F.col("value"), F.col("high_pass"), F.col("low_pass"))
    return (metrics.join(thresholds, list(on), "left").groupBy(*keys)
            .agg(F.bool_or(hit).cast("int").alias(out)))


def qc_wide(fov: DataFrame, metrics: DataFrame, names: Sequence[str], channels: Sequence[int],
            separator: str = "-") -> DataFrame:
    """Append one column per metric and channel to the field-of-view table."""
    wide = metrics.groupBy(*IMG).agg(*[
        F.max(F.when(F.col("channel") == ch, F.col(m))).alias(f"{m}{separator}{ch}")
        for m in names for ch in channels])
    return fov.join(wide, IMG, "left")


def unflagged(df: DataFrame, column: str = "flag", flag_value: int = 1) -> DataFrame:
    """Rows whose flag is not ``flag_value``; a NULL flag is kept."""
    return df.where(~F.col(column).eqNullSafe(flag_value))


def qc_band(df: DataFrame, column: str, center: float, radius: float) -> DataFrame:
    """Rows strictly inside (center - radius, center + radius)."""
    c = F.col(f"`{column}`")
    return df.where((c > center - radius) & (c < center + radius))


def qc_extremes(metrics: DataFrame, column: str, keys: Sequence[str] = ("channel",)) -> DataFrame:
    """Image with the lowest and the highest metric per group; ties give the smallest id."""
    v = F.col(column)
    return metrics.where(v.isNotNull()).groupBy(*keys).agg(
        F.min(F.struct(v.alias("v"), F.col("image_id"))).alias("lo"),
        F.min(F.struct((-v).alias("v"), F.col("image_id"))).alias("hi")).select(
        *keys, F.col("lo.image_id").alias("lowest_image"), F.col("lo.v").alias("lowest"),
        F.col("hi.image_id").alias("highest_image"), (-F.col("hi.v")).alias("highest"))


def qc_distribution(metrics: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Count, extremes, quartiles, mean and sample deviation of a metric per group."""
    plain = metrics.groupBy(*keys).agg(
        F.count(column).alias("n"), F.min(column).alias("min"), F.max(column).alias("max"),
        F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd"))
    quart = percentiles(metrics, keys, column, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return plain.join(quart, list(keys), "left")


_ARRAY = T.ArrayType(T.DoubleType())

LAPLACIAN = np.array([[0, 1, 0], [1, -4, 1], [0, 1, 0]], float)


def laplacian_variance(pixels: DataFrame, threshold: float = 100.0, mode: str = "reflect",
                       keys: Sequence[str] = tuple(IC), size: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Variance of the Laplacian per slice; ``blurry`` where it is below the threshold."""
    lap = map_blocks(pixels, lambda a: K.correlate(a, LAPLACIAN, mode), ["v"], halo=1, keys=keys, size=size, block=block)
    return (lap.groupBy(*keys).agg(F.var_pop("v").alias("laplacian_var"))
            .withColumn("blurry", F.col("laplacian_var") < threshold))


def _by_length(col: pa.Array, transform) -> pa.Array:
    """Apply a row-wise array transform to all lists of one length at a time."""
    sizes = col.value_lengths().to_numpy()
    flat, start = col.flatten().to_numpy(), np.concatenate([[0], sizes.cumsum()[:-1]]).astype(int)
    made: list[np.ndarray] = [np.empty(0)] * len(sizes)
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        for i, r in zip(rows, transform(flat[start[rows][:, None] + np.arange(n)])):
            made[i] = r
    offsets = np.concatenate([[0], np.cumsum([r.size for r in made])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(made)))


def _spectrum(rows: np.ndarray) -> np.ndarray:
    """Real parts then imaginary parts of the non-negative frequencies."""
    f = np.fft.rfft(rows, axis=1)
    return np.concatenate([f.real, f.imag], axis=1)


def _power(rows: np.ndarray) -> np.ndarray:
    """Power per frequency of rows holding real parts then imaginary parts."""
    n = rows.shape[1] // 2
    return np.abs(np.fft.fft(rows[:, :n] + 1j * rows[:, n:], axis=1)) ** 2


@F.arrow_udf(_ARRAY)
def _row_spectrum(rows: pa.Array) -> pa.Array:
    return _by_length(rows, _spectrum)


@F.arrow_udf(_ARRAY)
def _column_power(pairs: pa.Array) -> pa.Array:
    return _by_length(pairs, _power)


def _ordered(order: str, value: Column) -> Column:
    """Values of a group in coordinate order; bounded by one side of an image."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), value.alias("v"))))
    return F.transform(pairs, lambda s: s["v"])


def radial_power(pixels: DataFrame, keys: Sequence[str] = tuple(IC), mask_zero: bool = True) -> DataFrame:
    """Mean spectral power per integer radius, the zero frequency left out.

    The two-dimensional transform is split: one transform per image row, a shuffle by
    horizontal frequency, one transform per column. No task holds a whole image. Only
    non-negative horizontal frequencies are kept; the mirrored half counts by weight.
    """
    rows = (pixels.groupBy(*keys, "y").agg(_ordered("x", F.coalesce("value", F.lit(float("nan")))).alias("r"))
            .select(*keys, "y", F.size("r").alias("w"), _row_spectrum("r").alias("f")))
    half = (F.size("f") / 2).cast("int")
    freq = rows.select(*keys, "y", "w", half.alias("half"), "f").select(
        *keys, "y", "w", F.posexplode(F.arrays_zip(
            F.slice("f", F.lit(1), F.col("half")).alias("re"),
            F.slice("f", F.col("half") + 1, F.col("half")).alias("im"))).alias("kx", "c"))
    column = F.concat(_ordered("y", F.col("c.re")), _ordered("y", F.col("c.im")))
    power = (freq.groupBy(*keys, "w", "kx").agg(column.alias("col"))
             .select(*keys, "w", "kx", (F.size("col") / 2).cast("int").alias("h"), _column_power("col").alias("p")))
    flat = power.select(*keys, "w", "h", "kx", F.posexplode("p").alias("ky", "power"))
    fy = F.least(F.col("ky"), F.col("h") - F.col("ky"))
    twin = (F.col("kx") > 0) & (F.col("kx") * 2 != F.col("w"))
    weight = F.when(twin, 2).otherwise(1)
    out = (flat.withColumn("radius", F.floor(F.sqrt(F.col("kx") * F.col("kx") + fy * fy)).cast("int"))
           .where("radius > 0").groupBy(*keys, "radius")
           .agg((F.sum(F.col("power") * weight) / F.sum(weight)).alias("power")))
    return out.where((F.col("power") > 0) | F.isnan("power")) if mask_zero else out


def plls(pixels: DataFrame, keys: Sequence[str] = tuple(IC), mask_zero: bool = True) -> DataFrame:
    """Slope and intercept of log power against log radius; NULL below two radii."""
    bins = radial_power(pixels, keys, mask_zero)
    x, y = F.log("radius"), F.log("power")
    fit = bins.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                                  F.count("radius").cast("int").alias("n_radii"))
    ok = (F.col("n_radii") >= 2) & ~F.isnan("slope")
    fit = fit.withColumns({c: F.when(ok, F.col(c)) for c in ("slope", "intercept")})
    return pixels.select(*keys).distinct().join(fit, list(keys), "left")


def metrics_long(metrics: DataFrame, names: Sequence[str], keys: Sequence[str] = tuple(IC)) -> DataFrame:
    """(keys, metric, value) rows of wide metrics."""
    return metrics.unpivot(list(keys), list(names), "metric", "value")


