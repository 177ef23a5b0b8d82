"""Hessian and structure-tensor features of labelled objects."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelspark.functions import kernels as K
from pixelspark.functions.stats import resolve
from pixelspark.operators.blocks import BLOCK, image_size, map_blocks
from pixelspark.operators.fused import FROM_MOMENTS, fold_tiles, merged
from pixelspark.operators.measure import label_pixels
from pixelspark.operators.stencil import erode_labels
from pixelspark.schema import IC, ILC, IMG

STATS: Mapping[str, str] = {"intensity_mean": "mean", "intensity_max": "max",
                            "intensity_min": "min", "intensity_std": "std"}


def sigma_grid(low=None, high=None, num: int | None = None, ndim: int = 2) -> list[tuple[float, ...]]:
    """The sigmas to compute, one value per axis.

    Nothing given: one sigma of 1. One bound: that value. Two bounds: both, or ``num``
    evenly spaced values between them. Bounds are numbers, or one number per axis.
    """
    def axes(v) -> tuple[float, ...]:
        if isinstance(v, (int, float)):
            return (float(v),) * ndim
        v = tuple(float(a) for a in v)
        if len(v) != ndim:
            raise ValueError("one sigma per axis is needed")
        return v

    if low is None and high is None:
        return [(1.0,) * ndim]
    if low is None or high is None:
        return [axes(low if high is None else high)]
    if isinstance(low, (int, float)) != isinstance(high, (int, float)):
        raise ValueError("bounds must both be numbers or both be given per axis")
    a, b = axes(low), axes(high)
    if any(p > q for p, q in zip(a, b)) or a == b or (isinstance(low, (int, float)) and low >= high):
        raise ValueError("the lower sigma must be below the upper one")
    if num is None:
        return [a, b]
    return [tuple(float(v) for v in row) for row in np.linspace(a, b, num)]


def hessian_sigmas(low: float = 1.0, high: float = 1.0, num: int | None = None) -> list[tuple[float, float]]:
    """Sigmas of the Hessian, spaced evenly on a log scale; the lowest one alone where there is one.

    By default there are 1 + floor(log2(high / low)) of them, and one where ``high`` is at most twice ``low``.
    """
    if not 0 < low <= high:
        raise ValueError("sigmas must be positive, the lower one first")
    if num is None:
        num = 1 if high <= 2 * low else 1 + math.floor(math.log2(high / low))
    return [(s, s) for s in (low * (high / low) ** (i / (num - 1) if num > 1 else 0.0) for i in range(num))]


def _reach(sigmas: Sequence[tuple[float, ...]]) -> int:
    return max(K.gaussian_halo(s) for s in sigmas)


HESSIAN_MODE, TENSOR_MODE = "nearest", "constant"
_SMOOTH, _SLOPE = np.array([1.0, 2.0, 1.0]), np.array([-1.0, 0.0, 1.0])


def hessian_fields(a: np.ndarray, sigmas: Sequence[tuple[float, ...]], mode: str = HESSIAN_MODE) -> list[np.ndarray]:
    """Eigenvalues of each sigma, larger first, of one tile."""
    out = []
    for s in sigmas:
        g = K.gaussian(a, s, mode)
        dy, dx = K.gradient(g, -2), K.gradient(g, -1)
        out += K.eigen_2x2(K.gradient(dy, -2), K.gradient(dy, -1), K.gradient(dx, -1))
    return out


def tensor_fields(a: np.ndarray, sigmas: Sequence[tuple[float, ...]], mode: str = TENSOR_MODE, eps: float = 1e-6) -> list[np.ndarray]:
    """Both eigenvalues of each sigma and their ratio, of one tile."""
    gy = K.correlate(a, np.outer(_SLOPE, _SMOOTH), mode)
    gx = K.correlate(a, np.outer(_SMOOTH, _SLOPE), mode)
    out = []
    for s in sigmas:
        l1, l2 = K.eigen_2x2(*[K.gaussian(p, s, mode) for p in (gy * gy, gy * gx, gx * gx)])
        out += [l1, l2, l1 / (l2 + eps)]
    return out


def hessian_reach(sigmas: Sequence[tuple[float, ...]]) -> int:
    return _reach(sigmas) + 2


def tensor_reach(sigmas: Sequence[tuple[float, ...]]) -> int:
    return _reach(sigmas) + 1


def hessian_map(pixels: DataFrame, sigmas: Sequence[tuple[float, ...]], mode: str = HESSIAN_MODE,
                keys: Sequence[str] = tuple(IC), block: int = BLOCK, size: DataFrame | None = None) -> DataFrame:
    """Columns ``eigv_{k}_{s}``: Hessian eigenvalues (k=1 larger) of the image smoothed at sigma s.

    All sigmas of a channel come out of one pass over its tiles.
    """
    names = [f"eigv_{k}_{s}" for s in range(len(sigmas)) for k in (1, 2)]
    halo = hessian_reach(sigmas)
    return map_blocks(pixels, lambda a: hessian_fields(a, sigmas, mode), names, keys=keys, halo=halo, block=max(block, halo), size=size)


def structure_tensor_map(pixels: DataFrame, sigmas: Sequence[tuple[float, ...]], mode: str = TENSOR_MODE,
                         eps: float = 1e-6, keys: Sequence[str] = tuple(IC), block: int = BLOCK, size: DataFrame | None = None) -> DataFrame:
    """Columns ``eigv_{k}_{s}`` and ``anisotropy_{s}`` = eigv_1 / (eigv_2 + eps)."""
    names = [n for s in range(len(sigmas)) for n in (f"eigv_1_{s}", f"eigv_2_{s}", f"anisotropy_{s}")]
    halo = tensor_reach(sigmas)
    return map_blocks(pixels, lambda a: tensor_fields(a, sigmas, mode, eps), names, keys=keys, halo=halo, block=max(block, halo), size=size)


def image_mean_anisotropy(pixels: DataFrame, sigma: float = 1.0, eps: float = 1e-6,
                          keys: Sequence[str] = tuple(IC)) -> DataFrame:
    """Mean eigenvalue ratio of the whole slice."""
    field = structure_tensor_map(pixels, [(sigma, sigma)], eps=eps, keys=keys)
    return field.groupBy(*keys).agg(F.avg("anisotropy_0").alias("mean_anisotropy"))


def long_features(field: DataFrame, columns: Mapping[str, tuple[str, int | None]],
                  labels: DataFrame, stats: Mapping[str, str] = STATS) -> DataFrame:
    """(image, label, channel, feature, sigma, stat, value) of a per-pixel field under labels.

    ``columns`` maps each field column to its feature name and sigma index.
    """
    px = label_pixels(field, labels)
    wide = px.groupBy(*ILC).agg(*[a for c in columns for a in _stat_columns(c, stats)])
    rows = F.array(*[F.struct(F.lit(feature).alias("feature"), F.lit(sigma).cast("int").alias("sigma"),
                              F.lit(s).alias("stat"), F.col(f"`{c}|{s}`").alias("value"))
                     for c, (feature, sigma) in columns.items() for s in stats])
    return wide.select(*ILC, F.inline(rows))


def _stat_columns(column: str, stats: Mapping[str, str]):
    return [resolve(s)(F.col(column)).alias(f"{column}|{name}") for name, s in stats.items()]


def feature_name(feature: str, stat: str, sigma: int | None, channel: int | None, pair: str = "",
                 sep: str = "_", channel_sep: str = "-") -> str:
    """``{feature}_{stat}[_{pair}][_{sigma}][-{channel}]``."""
    name = sep.join(str(p) for p in (feature, stat, pair or None, sigma) if p is not None)
    return name if channel is None else f"{name}{channel_sep}{channel}"


def rename_features(df: DataFrame, keep: Sequence[str] = ("label",), prefix: str | None = None,
                    suffix: str | None = None, sep: str = "_", suffix_sep: str | None = None) -> DataFrame:
    """Prefix and suffix on every column but those to keep."""
    def name(c: str) -> str:
        c = c if prefix is None else f"{prefix}{sep}{c}"
        return c if suffix is None else f"{c}{sep if suffix_sep is None else suffix_sep}{suffix}"
    return df.withColumnsRenamed({c: name(c) for c in df.columns if c not in keep})


def merge_features(first: DataFrame, *rest: DataFrame, how: str = "left", on: Sequence[str] = (*IMG, "label")) -> DataFrame:
    """Object tables side by side; ``full_outer`` keeps the objects of any of them."""
    for other in rest:
        first = first.join(other, list(on), how)
    return first


def wide_features(long: DataFrame, features: Sequence[tuple[str, str]], stats: Sequence[str],
                  n_sigma: int, channels: Sequence[int], sep: str = "_", channel_sep: str = "-") -> DataFrame:
    """One row per object; sigma and channel enter a name only where there are several."""
    out = []
    for feature, pair in features:
        for s in range(n_sigma):
            for ch in channels:
                for stat in stats:
                    hit = ((F.col("feature") == feature) & (F.col("sigma") == s) & (F.col("channel") == ch)
                           & (F.col("stat") == stat))
                    name = feature_name(feature, stat, s if n_sigma > 1 else None,
                                        ch if len(channels) > 1 else None, pair, sep, channel_sep)
                    out.append(F.max(F.when(hit, F.col("value"))).alias(name))
    return long.groupBy(*IMG, "label").agg(*out)


HESSIAN_NAMES = lambda n: [f"hessian_eigv_{k}|{s}" for s in range(n) for k in (1, 2)]
TENSOR_NAMES = lambda n: [f"{f}|{s}" for s in range(n) for f in ("str_tens_eigv_1", "str_tens_eigv_2", "anisotropy")]


def object_partials(pixels: DataFrame, labels: DataFrame, *, hessian: Sequence[tuple[float, ...]] = (), tensor: Sequence[tuple[float, ...]] = (),
                    smooth: float | None = None, intensity: bool = False, perimeter: Callable[[np.ndarray], np.ndarray] | None = None,
                    erosion: int = 9, eps: float = 1e-6, size: DataFrame | None = None, block: int = BLOCK, outlines: bool = False) -> DataFrame:
    """Merged moments per (image, label, channel, field), from one pass over tiles of pixels and labels.

    The steps run on the arrays of a tile one after another: smoothing, intensity under the labels, erosion, eigenvalues under the
    eroded labels, and, without a channel, the perimeter. Fields are ``intensity``, ``perimeter`` and ``{feature}|{sigma}``, with
    ``outlines`` also ``area_convex``, ``feret`` and ``holes``. Small images go through the steps together, so ``perimeter`` gets and
    returns arrays whose last two axes are those of a tile.
    Where ``size`` is not given an image ends at the largest y and x of its pixels and labels.
    """
    reach = (K.gaussian_halo(smooth) if smooth else 0) + max([0, *([hessian_reach(hessian)] if hessian else []), *([tensor_reach(tensor)] if tensor else [])])
    halo = max(reach, erosion, 2 if perimeter else 0)

    def label_kernel(label: np.ndarray):
        fields = [("perimeter", perimeter(label), label)] if perimeter else []
        return {"all": label, "eroded": K.erode_min(label, K.disk(erosion)) if erosion else label}, fields

    def channel_kernel(a: np.ndarray, under: dict[str, np.ndarray]):
        if smooth:
            a = K.gaussian(a, smooth, "nearest")
        if intensity:
            yield "intensity", a, under["all"]
        for name, field in zip(HESSIAN_NAMES(len(hessian)), hessian_fields(a, hessian)):
            yield name, field, under["eroded"]
        if tensor:
            for name, field in zip(TENSOR_NAMES(len(tensor)), tensor_fields(a, tensor, eps=eps)):
                yield name, field, under["eroded"]

    block = max(block, halo)
    return merged(fold_tiles(pixels, labels, channel_kernel, label_kernel, halo=halo, size=size, block=block, outlines=outlines, stack=True), outlines, block)


def _long(found: DataFrame, stats: Mapping[str, str]) -> DataFrame:
    """(image, label, channel, feature, sigma, stat, value) of merged moments."""
    part = F.split("field", r"\|")
    rows = F.array(*[F.struct(F.lit(name).alias("stat"), FROM_MOMENTS[s]().alias("value")) for name, s in stats.items()])
    return found.select(*ILC, part[0].alias("feature"), part[1].cast("int").alias("sigma"), F.inline(rows))


def hessian_features(pixels: DataFrame, labels: DataFrame, sigmas: Sequence[tuple[float, ...]],
                     erosion: int = 9, size: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Long per-object statistics of the Hessian eigenvalues on eroded labels, from one pass over tiles."""
    return _long(object_partials(pixels, labels, hessian=list(sigmas), erosion=erosion, size=size, block=block), STATS)


def structure_tensor_features(pixels: DataFrame, labels: DataFrame, sigmas: Sequence[tuple[float, ...]],
                              erosion: int = 9, size: DataFrame | None = None, eps: float = 1e-6, block: int = BLOCK) -> DataFrame:
    """Long per-object statistics of both eigenvalues and their ratio on eroded labels, from one pass over tiles."""
    return _long(object_partials(pixels, labels, tensor=list(sigmas), erosion=erosion, eps=eps, size=size, block=block), STATS)


def eroded(labels: DataFrame, radius: int, pixels: DataFrame, size: DataFrame | None = None) -> DataFrame:
    """Eroded labels; an image is as large as its pixels and labels where ``size`` is not given."""
    if not radius:
        return labels.where("label > 0")
    if size is None:
        size = image_size(pixels.select(*IMG, "y", "x").union(labels.select(*IMG, "y", "x")), IMG)
    return erode_labels(labels, size, radius)
