"""Quality table, background model, correction and object table, each one Spark plan.

Steps hand each other DataFrames. A study writes the background with ``write_image_table`` and
reads it back before correcting: as a table its size is known, and while it is below the
broadcast threshold the pixels are corrected without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelspark.operators import background as bg
from pixelspark.operators import labels as lb
from pixelspark.operators import measure, qc, shape, stencil, tensors
from pixelspark.operators.blocks import BLOCK, image_size
from pixelspark.operators.fused import FROM_MOMENTS
from pixelspark.schema import IC, IL, IMG

Bounds = Mapping[str, tuple[float | None, float | None]]


#: Metrics that are no plain aggregate of the pixels of a channel, by the pass that they come from.
EXTREMES, TAILS, BLUR = ("bottom_fraction", "top_fraction"), ("low_mean", "high_mean"), "laplacian_var"


def quality_metrics(pixels: DataFrame, names: Sequence[str], smooth: int | None = None, low: float = 1.0, high: float = 99.0, size: DataFrame | None = None) -> DataFrame:
    """Metrics per (image, channel); aggregates share one pass over the pixels.

    ``names``: statistics, ``plls``, the shares of extreme pixels, the means of both tails (between ``low`` and ``high``
    per cent) and ``laplacian_var``. ``smooth`` is the size of a median filter in front of all but ``plls`` and the Laplacian.
    """
    special = {"plls", BLUR, *EXTREMES, *TAILS}
    plain = [n for n in names if n not in special]
    px = stencil.median_filter(pixels, smooth, size_of=size) if smooth else pixels
    parts = [measure.image_stat(px, {n: n for n in plain}, IC)] if plain else []
    if "plls" in names:
        parts.append(qc.plls(pixels).select(*IC, F.col("slope").alias("plls")))
    if any(n in names for n in EXTREMES):
        parts.append(measure.extreme_fraction(px, low, high).select(*IC, *[n for n in EXTREMES if n in names]))
    if any(n in names for n in TAILS):
        parts.append(measure.low_high_tail(px, low, high).select(*IC, *[n for n in TAILS if n in names]))
    if BLUR in names:
        parts.append(qc.laplacian_variance(pixels, size=size).select(*IC, BLUR))
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, IC, "full_outer")
    return out


def quality_table(fov: DataFrame, pixels: DataFrame, channels: Sequence[int], bounds: Bounds,
                  smooth: int | None = None) -> DataFrame:
    """Wide metrics and a flag per field of view; an image without pixels keeps a row of NULLs.

    ``bounds`` maps a metric to its (high-pass, low-pass) values, used for every channel.
    """
    wide = qc.qc_wide(fov, quality_metrics(pixels, list(bounds), smooth), list(bounds), channels)
    columns = [f"{m}-{c}" for m in bounds for c in channels]
    high = [bounds[m][0] for m in bounds for _ in channels]
    low = [bounds[m][1] for m in bounds for _ in channels]
    return qc.flag_rows(wide, columns, low, high)


def background_model(pixels: DataFrame, flagged: DataFrame, condition: Sequence[str] = (), method: str = "median",
                     fit: str | None = None, **settings) -> DataFrame:
    """Background of the unflagged fields of view, optionally fitted, per condition."""
    good = pixels.join(qc.unflagged(flagged).select(*IMG), IMG, "left_semi")
    stack = bg.background_stack(good, method, condition)
    return stack if fit is None else bg.fit_background(stack, fit, [*condition, "channel"], **settings)


def correct(pixels: DataFrame, model: DataFrame, offset: float = 400.0, condition: Sequence[str] = (),
            **settings) -> DataFrame:
    """Flat-field correction with the workflow's settings; any of them can be replaced."""
    defaults = {"method": "division", "rescale": "max", "offset_background": True}
    return bg.correct_pixels(pixels, model, offset=offset, condition=condition, **(defaults | settings))


def object_intensities(pixels: DataFrame, labels: DataFrame) -> DataFrame:
    """Area and intensity per (object, channel), label rows driving the join."""
    px = measure.label_pixels(pixels, labels.where("label > 0"))
    stats = {n: s for n, s in measure.OBJECT_STATS.items() if n in
             ("intensity_mean", "intensity_max", "intensity_min", "intensity_std")}
    return measure.image_stat(px, stats | {"area": lambda v: F.count(F.lit(1))}, [*IL, "channel"])


def extra_intensity(pixels: DataFrame, labels: DataFrame, extra: Mapping[str, str | measure.Stat], channels: Sequence[int]) -> DataFrame:
    """One row per object with ``{name}-{channel}`` of further intensity properties.

    A name of ``measure.object_intensity`` (``intensity_median``, ``intensity_skew``, ``intensity_mad``, ...) is read from the
    distinct values of an object and their counts; anything else is an aggregate of the caller's, see ``measure.image_stat``.
    """
    px = measure.label_pixels(pixels, labels.where("label > 0"))
    known = [n for n, s in extra.items() if isinstance(s, str) and s.startswith("intensity_")]
    own = {n: s for n, s in extra.items() if n not in known}
    parts = []
    if known:
        parts.append(measure.object_intensity(px).select(*IL, "channel", *[F.col(extra[n]).alias(n) for n in known]))
    if own:
        parts.append(measure.image_stat(px, own, [*IL, "channel"]))
    long = parts[0] if len(parts) == 1 else parts[0].join(parts[1], [*IL, "channel"], "full_outer")
    return long.groupBy(*IL).agg(*[F.max(F.when(F.col("channel") == c, F.col(n))).alias(f"{n}-{c}") for n in extra for c in channels])


def object_table(pixels: DataFrame, labels: DataFrame, channels: Sequence[int], sigma: float | None = 3.0,
                 hessian: Sequence[tuple[float, ...]] | None = ((1.0, 1.0),),
                 tensor: Sequence[tuple[float, ...]] | None = ((1.0, 1.0),), erosion: int = 9,
                 extra: Mapping[str, str | measure.Stat] | None = None, size: DataFrame | None = None,
                 block: int = BLOCK) -> DataFrame:
    """One row per object off the edge: shape, intensity, Hessian and structure-tensor features.

    Smoothing, erosion, eigenvalues, perimeter, hulls and holes run on the arrays of one pass over tiles, which returns partial
    sums for each object. Objects that erosion leaves no pixel of have no eigenvalue rows, and are left out where these are asked for.
    ``extra`` names further intensity properties of the smoothed pixels; they take a pass of their own. ``size`` has height and
    width of each image and spares a pass over the pixels.
    """
    size = size if size is not None else image_size(pixels)
    labels = lb.exclude_edge_labels(labels, size)
    hessian, tensor = list(hessian or ()), list(tensor or ())
    found = tensors.object_partials(pixels, labels, hessian=hessian, tensor=tensor, smooth=sigma, intensity=True,
                                    perimeter=shape.perimeter_weights, erosion=erosion, size=size, block=block, outlines=True)

    def column(field: str, channel: int | None, stat: str, name: str) -> Column:
        hit = (F.col("field") == field) & F.col("channel").eqNullSafe(F.lit(channel))
        return F.max(F.when(hit, FROM_MOMENTS[stat]())).alias(name)

    stats = tensors.STATS
    outline = {"perimeter": "sum", "area_convex": "mean", "feret": "mean", "holes": "mean"}
    columns = [column(f, None, how, "feret_diameter_max" if f == "feret" else f) for f, how in outline.items()]
    columns += [column("intensity", c, s, f"{n}-{c}") for n, s in stats.items() for c in channels]
    needed = []
    for sigmas, features in ((hessian, [(f"hessian_eigv_{k}", "") for k in (1, 2)]),
                             (tensor, [("str_tens_eigv_1", ""), ("str_tens_eigv_2", ""), ("anisotropy", "1_2")])):
        for feature, pair in features if sigmas else ():
            for i in range(len(sigmas)):
                columns += [column(f"{feature}|{i}", c, s, tensors.feature_name(feature, n, i if len(sigmas) > 1 else None, c if len(channels) > 1 else None, pair))
                            for c in channels for n, s in stats.items()]
        if sigmas:
            needed.append(F.count_if(F.col("field") == f"{features[0][0]}|0") > 0)
    wide = found.groupBy(*IL).agg(*columns, *[n.alias(f"_has_{i}") for i, n in enumerate(needed)])
    for i in range(len(needed)):
        wide = wide.where(F.col(f"_has_{i}")).drop(f"_has_{i}")
    wide = wide.withColumns({c: F.col(c).cast("bigint") for c in ("area_convex", "holes")})
    out = shape.object_shape(labels, found=wide)
    if needed:
        out = out.where("area_convex is not null")
    if extra:
        px = stencil.gaussian_filter(pixels, sigma, size=size, block=block) if sigma else pixels
        out = out.join(extra_intensity(px, labels, extra, channels), IL, "left")
    return out
