"""Neighbourhood operators: local statistics, filters, padding, resizing, label erosion."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelspark.functions import kernels as K
from pixelspark.functions.stats import Stat
from pixelspark.operators import ranking
from pixelspark.operators.blocks import BLOCK, image_keys, image_size, map_blocks
from pixelspark.operators.measure import extreme_fraction, image_stat, low_high_tail, tails_spread, tails_whole
from pixelspark.operators.ranking import of_groups
from pixelspark.schema import IC, IMG


def _footprint(size: int | tuple[int, int] | None, footprint) -> np.ndarray:
    if footprint is not None:
        return np.asarray(footprint, bool)
    return np.ones((size, size) if isinstance(size, int) else size, bool)


def local_map(pixels: DataFrame, stat: str | Callable, size: int | tuple[int, int] | None = 3,
              footprint=None, mode: str = "symmetric", out: str = "value",
              keys: Sequence[str] = tuple(IC), block: int = BLOCK, size_of: DataFrame | None = None) -> DataFrame:
    """A statistic of the window around each pixel; windows never cross slices.

    ``stat`` is a registered name or a function from the window values on the last axis to
    one number per pixel. ``size_of`` has height and width of each image, see ``map_blocks``. With a registered one small
    images are handed to the kernel together.
    """
    fp = _footprint(size, footprint)
    fn = K.LOCAL[stat] if isinstance(stat, str) else stat
    return map_blocks(pixels, lambda a: K.local(a, fp, mode, fn), [out], keys=keys,
                      halo=max(fp.shape) // 2, block=block, size=size_of, stack=isinstance(stat, str))


def median_filter(pixels: DataFrame, size: int = 3, footprint=None, mode: str = "symmetric",
                  keys: Sequence[str] = tuple(IC), block: int = BLOCK, size_of: DataFrame | None = None) -> DataFrame:
    return local_map(pixels, "median", size, footprint, mode, keys=keys, block=block, size_of=size_of)


def aggregate_local(pixels: DataFrame, local: str | Callable, stats: dict[str, str | Stat],
                    size: int = 3, footprint=None, mode: str = "symmetric",
                    keys: Sequence[str] = tuple(IC), by: Sequence[str] | None = None) -> DataFrame:
    """Aggregate the local map per image, or per slice with ``by`` holding the slice axis."""
    return image_stat(local_map(pixels, local, size, footprint, mode, keys=keys), stats, by or IMG)


def local_mean_over_std(pixels: DataFrame, size: int = 3, mode: str = "symmetric",
                        keys: Sequence[str] = tuple(IC)) -> DataFrame:
    """Mean over slices' windows of mean / std; flat windows do not count."""
    return aggregate_local(pixels, "mean_over_std", {"local_mean_over_std": "mean"}, size, mode=mode, by=keys)


#: A filter that reaches farther than this runs along the rows and then along the columns, on strips of STRIP pixels.
WIDE, STRIP = 32, (1024, 64)


def gaussian_filter(pixels: DataFrame, sigma: float = 0.6, mode: str = "nearest", truncate: float = 4.0,
                    keys: Sequence[str] = tuple(IC), block: int = BLOCK, size: DataFrame | None = None) -> DataFrame:
    """Gaussian smoothing inside each channel.

    A wide one takes two shuffles, each with a halo on one axis: a task then holds a strip of STRIP pixels and its halo (at sigma
    100 1,824 x 64 doubles, 0.9 MB), and a pixel is sent (1 + 2 halo / 1024) times, in place of the square of that.
    """
    halo = K.gaussian_halo(sigma, truncate)
    if halo <= WIDE:
        return map_blocks(pixels, lambda a: K.gaussian(a, sigma, mode, truncate), ["value"], keys=keys,
                          halo=halo, block=max(block, halo), size=size)
    along, across = max(STRIP[0], halo), STRIP[1]
    w = K.gaussian_weights(sigma, truncate)
    size = size if size is not None else image_size(pixels, keys)
    first = map_blocks(pixels, lambda a: K.correlate_wide(a, w, 0, mode), ["value"], keys=keys, halo=(halo, 0), block=(along, across), size=size)
    return map_blocks(first, lambda a: K.correlate_wide(a, w, 1, mode), ["value"], keys=keys, halo=(0, halo), block=(across, along), size=size)


def convolve(pixels: DataFrame, kernel, mode: str = "symmetric", keys: Sequence[str] = tuple(IC),
             block: int = BLOCK, size: DataFrame | None = None) -> DataFrame:
    """Convolution with an odd-sized kernel (mirrored, as convolution is defined)."""
    k = np.asarray(kernel, float)[::-1, ::-1]
    return map_blocks(pixels, lambda a: K.correlate(a, k, mode), ["value"], keys=keys,
                      halo=max(k.shape) // 2, block=max(block, max(k.shape)), size=size)


def low_high_tail_channel(pixels: DataFrame, low: float, high: float, stat: str = "mean",
                          smooth: int | None = None, mode: str = "nearest",
                          keys: Sequence[str] = tuple(IC)) -> DataFrame:
    """Tail statistics per channel, after an optional median filter.

    A slice has as many filtered pixels as its image has places, so images are told apart by their size in front of the filter, which
    is run once on those of at most ``ranking.GROUP_ROWS`` pixels.
    """
    if not smooth:
        return low_high_tail(pixels, low, high, stat, keys)
    size, area = image_size(pixels, keys), F.col("height").cast("bigint") * F.col("width")
    large = size.where(area > ranking.GROUP_ROWS)

    def filtered(big: bool) -> DataFrame:
        part = large if big else size.where(area <= ranking.GROUP_ROWS)
        return median_filter(of_groups(pixels, large.select(*image_keys(keys)), big), smooth, mode=mode, keys=keys, size_of=part)

    return tails_whole(filtered(False), low, high, stat, keys).unionByName(tails_spread(filtered(True), low, high, stat, keys))


def extreme_fraction_channel(pixels: DataFrame, low: float = 1.0, high: float = 99.0, smooth: int | None = None, footprint=None,
                             mode: str = "nearest", keys: Sequence[str] = tuple(IC),
                             size: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Shares of extreme pixels per channel, after an optional median filter of a size or a footprint."""
    if smooth or footprint is not None:
        pixels = median_filter(pixels, smooth, footprint, mode, keys, block, size)
    return extreme_fraction(pixels, low, high, keys)


def _mirror(c: Column, length: Column, width: int, mode: str) -> Column:
    """Coordinates (in the padded frame) at which a row or column of the image appears."""
    here = c + width
    if mode == "symmetric":
        before, after = F.lit(width - 1) - c, length * 2 + width - 1 - c
        ok_b, ok_a = c < width, c >= length - width
    else:
        before, after = F.lit(width) - c, length * 2 + width - 2 - c
        ok_b, ok_a = (c > 0) & (c <= width), (c < length - 1) & (c >= length - 1 - width)
    return F.filter(F.array(here, F.when(ok_b, before), F.when(ok_a, after)), lambda v: v.isNotNull())


def pad(pixels: DataFrame, width: int, shape: DataFrame, mode: str = "reflect", cval: float = 0.0) -> DataFrame:
    """Border rows and columns of ``width`` around each image; coordinates start at the new corner.

    ``shape`` has one row per image with ``height`` and ``width``, both at least ``width``
    (one more for ``reflect``). A mirrored pixel is emitted again at its mirror positions;
    constant borders are generated from the shape.
    """
    shape = shape.select(*IMG, F.col("height").alias("_h"), F.col("width").alias("_w"))
    if mode == "constant":
        body = pixels.withColumns({"y": F.col("y") + width, "x": F.col("x") + width})
        frame = (pixels.select(*IC).distinct().join(shape, IMG)
                 .withColumn("y", F.explode(F.sequence(F.lit(0), F.col("_h") + (2 * width - 1)))))
        inner = F.col("y").between(F.lit(width), F.col("_h") + (width - 1))
        edge = F.concat(F.sequence(F.lit(0), F.lit(width - 1)),
                        F.sequence(F.col("_w") + width, F.col("_w") + (2 * width - 1)))
        every = F.sequence(F.lit(0), F.col("_w") + (2 * width - 1))
        border = frame.withColumn("x", F.explode(F.when(inner, edge).otherwise(every)))
        return body.unionByName(border.select(*IC, "y", "x", F.lit(float(cval)).alias("value")))
    px = pixels.join(shape, IMG)
    px = px.withColumn("y", F.explode(_mirror(F.col("y"), F.col("_h"), width, mode)))
    px = px.withColumn("x", F.explode(_mirror(F.col("x"), F.col("_w"), width, mode)))
    return px.drop("_h", "_w")


def downsample_mean(pixels: DataFrame, factor: int, keys: Sequence[str] = tuple(IC),
                    shape: DataFrame | None = None) -> DataFrame:
    """Mean of factor x factor cells; rows and columns beyond a whole cell are left out."""
    if shape is not None:
        whole = shape.select(*IMG, (F.floor(F.col("height") / factor) * factor).alias("_h"),
                             (F.floor(F.col("width") / factor) * factor).alias("_w"))
        pixels = pixels.join(whole, IMG).where("y < _h and x < _w")
    cell = {c: F.floor(F.col(c) / factor).cast("int") for c in ("y", "x")}
    return pixels.withColumns(cell).groupBy(*keys, "y", "x").agg(F.avg("value").alias("value"))


def upsample_nearest(pixels: DataFrame, source: tuple[int, int], target: tuple[int, int],
                     value: str = "value") -> DataFrame:
    """Target pixel (Y, X) takes the source pixel (floor(Y*h/H), floor(X*w/W))."""
    for c, n, m in (("y", source[0], target[0]), ("x", source[1], target[1])):
        first = F.ceil(F.col(c) * m / n).cast("int")
        last = (F.ceil((F.col(c) + 1) * m / n) - 1).cast("int")
        hit = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        pixels = pixels.withColumn(c, F.explode(hit))
    return pixels


def match_shape(pixels: DataFrame, source: tuple[int, int], target: tuple[int, int],
                pad_value: float = 0.0, keys: Sequence[str] = tuple(IC), value: str = "value") -> DataFrame:
    """Centred crop or pad to a target height and width, each dimension on its own.

    An odd surplus cell of a padded dimension goes to the end.
    """
    out = pixels
    for c, n, m in (("y", source[0], target[0]), ("x", source[1], target[1])):
        shift = (m - n) // 2 if m >= n else -((n - m) // 2)
        out = out.withColumn(c, F.col(c) + shift).where(F.col(c).between(0, m - 1))
    if target[0] <= source[0] and target[1] <= source[1]:
        return out
    top, left = (max((m - n) // 2, 0) for n, m in zip(source, target))
    rows, cols = (min(n, m) for n, m in zip(source, target))
    frame = pixels.select(*keys).distinct().withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(target[0] - 1))))
    frame = frame.withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(target[1] - 1))))
    inside = F.col("y").between(top, top + rows - 1) & F.col("x").between(left, left + cols - 1)
    return out.unionByName(frame.where(~inside).withColumn(value, F.lit(pad_value).cast(out.schema[value].dataType)))


def erode_labels(labels: DataFrame, size: DataFrame, radius: int = 9, footprint=None,
                 keys: Sequence[str] = tuple(IMG), block: int = BLOCK) -> DataFrame:
    """Minimum label under a disk; positions outside the image are ignored, background is 0.

    ``size`` has height and width of each image: stored labels do not tell where an image ends, so it has no default.
    Only pixels left with a positive label are returned.
    """
    fp = K.disk(radius) if footprint is None else np.asarray(footprint, bool)
    out = map_blocks(labels.withColumn("label", F.col("label").cast("double")),
                     lambda a: K.erode_min(a, fp), ["label"], values=["label"], keys=keys,
                     halo=max(fp.shape) // 2, block=max(block, max(fp.shape)), fill=[0.0], size=size)
    return out.where("label > 0").withColumn("label", F.col("label").cast("int"))


def rolling_ball(pixels: DataFrame, radius: int = 50, white_background: bool = False,
                 max_value: float = 65535.0, smooth: float | None = None, kernel=None,
                 keys: Sequence[str] = tuple(IC), block: int = BLOCK, size: DataFrame | None = None) -> DataFrame:
    """Background under a rolling ball, optionally smoothed by a Gaussian or a kernel.

    A white background is inverted before and after (``max_value - v``). Both steps run on
    tiles whose halo is the ball radius, respectively the reach of the smoothing.
    """
    return rolling_ball_per_channel(pixels, {None: radius}, {None: smooth}, {None: white_background}, kernel, max_value, keys, block, size)


def smooth_background(pixels: DataFrame, sigma: float | None = None, kernel=None,
                      keys: Sequence[str] = tuple(IC), block: int = BLOCK, dtype: str | None = None,
                      size: DataFrame | None = None) -> DataFrame:
    """Gaussian smoothing for a sigma, convolution for a kernel, unchanged for neither."""
    if sigma is not None:
        pixels = gaussian_filter(pixels, sigma, "symmetric", keys=keys, block=block, size=size)
    elif kernel is not None:
        pixels = convolve(pixels, kernel, "symmetric", keys, block, size)
    return pixels.withColumn("value", F.col("value").cast(dtype)) if dtype else pixels


def rolling_ball_per_channel(pixels: DataFrame, radius: dict[int | None, int], smooth: dict[int | None, float | None] | None = None,
                             white_background: dict[int | None, bool] | None = None, kernel=None, max_value: float = 65535.0,
                             keys: Sequence[str] = tuple(IC), block: int = BLOCK, size: DataFrame | None = None) -> DataFrame:
    """Rolling ball with its own settings per channel, in one pass over the pixels; channel None stands for all others.

    Channels without settings are left out. A tile carries the halo of the largest radius, and every channel uses as much of
    it as its own needs. Smoothing takes one further pass for each sigma that is asked for.
    """
    smooth, white = smooth or {}, white_background or {}
    every = None in radius
    px = pixels if every else pixels.where(F.col("channel").isin(*radius))
    named = [c for c in {*radius, *white} if c is not None]
    of = lambda table, default: _by_channel({c: table.get(c, table.get(None, default)) for c in named}, table.get(None, default))
    size = size if size is not None else image_size(px, keys)
    invert = of(white, False)
    turned = px.withColumn("value", F.when(invert, F.lit(max_value) - F.col("value")).otherwise(F.col("value")))
    halo = max(radius.values())
    ball = turned.withColumn("_radius", of(radius, 0).cast("double"))
    out = map_blocks(ball, lambda a, r, core: K.ball_background(a, int(np.nanmax(r)), core), ["value"], values=["value", "_radius"], keys=keys,
                     halo=halo, block=max(block, halo), size=size, core=True)
    out = out.withColumn("value", F.when(invert, F.lit(max_value) - F.col("value")).otherwise(F.col("value")))
    if kernel is not None and not any(smooth.values()):
        return smooth_background(out, None, kernel, keys, block, size=size)
    sigmas = {c: smooth.get(c, smooth.get(None)) for c in named} | {None: smooth.get(None)}
    if len(set(sigmas.values())) == 1:
        return smooth_background(out, sigmas[None], None, keys, block, size=size)
    done = None
    for sigma in dict.fromkeys(sigmas.values()):
        mine = [c for c in named if sigmas[c] == sigma]
        part = F.col("channel").isin(*mine) if mine else F.lit(False)
        if every and sigmas[None] == sigma:
            part = ~F.col("channel").isin(*[c for c in named if sigmas[c] != sigma])
        one = smooth_background(out.where(part), sigma, None, keys, block, size=size)
        done = one if done is None else done.unionByName(one)
    return done


def _by_channel(table: dict[int, object], default) -> Column:
    """The setting of a row's channel."""
    out = F.lit(default)
    for c, v in table.items():
        out = F.when(F.col("channel") == c, F.lit(v)).otherwise(out)
    return out
