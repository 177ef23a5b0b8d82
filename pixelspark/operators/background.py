"""Illumination background: stack statistic, polynomial surface, pixel correction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelspark.functions.pixel import clip_cast
from pixelspark.operators.stencil import rolling_ball, rolling_ball_per_channel

CYX = ("channel", "y", "x")


def background_stack(pixels: DataFrame, method: str = "median", keys: Sequence[str] = ()) -> DataFrame:
    """Median or mean over the fields of view at each (channel, y, x).

    ``keys`` adds the condition (well, grid position) for one background each. A group holds one value per field of view,
    so the counters of its median are bounded by their number, and one aggregation does.
    """
    on = [*keys, *CYX]
    if method == "mean":
        return pixels.groupBy(*on).agg(F.avg("value").alias("value"))
    if method != "median":
        raise ValueError("method must be median or mean")
    return pixels.groupBy(*on).agg(F.percentile("value", 0.5).alias("value"))


def background_all_strategies(pixels: DataFrame, conditions: Sequence[str], method: str = "median") -> DataFrame:
    """Backgrounds over all fields and per condition column in one pass (grouping sets)."""
    agg = F.percentile("value", 0.5) if method == "median" else F.avg("value")
    sets = [[F.col(c) for c in CYX], *[[F.col(k), *[F.col(c) for c in CYX]] for k in conditions]]
    rows = pixels.groupingSets(sets, *conditions, *CYX).agg(
        agg.alias("value"), F.grouping_id(*conditions, *CYX).alias("_gid"))
    n = len(conditions) + len(CYX)
    full = (1 << n) - 1
    names = {full & ~((1 << len(CYX)) - 1): "all"}
    for i, k in enumerate(conditions):
        names[(full & ~((1 << len(CYX)) - 1)) & ~(1 << (n - 1 - i))] = k
    strategy = F.lit(None).cast("string")
    for gid, name in names.items():
        strategy = F.when(F.col("_gid") == gid, name).otherwise(strategy)
    key = F.coalesce(*[F.col(c).cast("string") for c in conditions], F.lit(""))
    return rows.select(strategy.alias("strategy"), key.alias("strategy_key"), *CYX, "value")


# --- polynomial surface -------------------------------------------------------------------

def _terms(kx: int, ky: int, order: int | None) -> list[tuple[int, int]]:
    """(x power, y power) pairs of the surface."""
    return [(i, j) for i in range(kx + 1) for j in range(ky + 1) if order is None or i + j <= order]


def _scaled(c: str, length: Column) -> Column:
    """Coordinate mapped to [-1, 1]; keeps the normal equations well conditioned."""
    return F.coalesce(F.try_divide(F.col(c) * 2.0, length - 1) - 1.0, F.lit(0.0))


Degree = int | Mapping[int, int]


def _degree_table(kx: Degree, ky: Degree, order) -> dict[int | None, tuple[int, int, int | None]]:
    """(kx, ky, order) per channel; ``None`` stands for every channel."""
    maps = [s for s in (kx, ky, order) if isinstance(s, Mapping)]
    if not maps:
        return {None: (kx, ky, order)}
    if len(maps) != 3 or len({frozenset(m) for m in maps}) != 1:
        raise ValueError("give kx, ky and order per channel for the same channels, or none of them")
    return {c: (kx[c], ky[c], order[c]) for c in kx}


def polyfit(background: DataFrame, kx: Degree = 3, ky: Degree = 3, order=None,
            keys: Sequence[str] = ("channel",)) -> DataFrame:
    """Least-squares coefficients of value ~ x^i y^j per group, in coordinates scaled to [-1, 1].

    All moment sums come from one aggregation with map-side partial sums; what remains per
    group is a system of at most (kx+1)(ky+1) unknowns.
    """
    table = _degree_table(kx, ky, order)
    ax = max(t[0] for t in table.values())
    ay = max(t[1] for t in table.values())
    size = background.groupBy(*keys).agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))
    b = background.join(size, list(keys)).withColumns(
        {"_u": _scaled("x", F.col("width")), "_v": _scaled("y", F.col("height"))})
    powers = {c: [F.lit(1.0), F.col(c)] for c in ("_u", "_v")}
    for c, top in (("_u", 2 * ax), ("_v", 2 * ay)):
        while len(powers[c]) <= top:
            powers[c].append(powers[c][-1] * F.col(c))
    moments = F.array(*[F.sum(powers["_u"][i] * powers["_v"][j])
                        for i in range(2 * ax + 1) for j in range(2 * ay + 1)])
    right = F.array(*[F.sum(powers["_u"][i] * powers["_v"][j] * F.col("value"))
                      for i in range(ax + 1) for j in range(ay + 1)])
    sums = b.where(F.col("value").isNotNull()).groupBy(*keys, "height", "width").agg(
        moments.alias("m"), right.alias("r"))
    wanted = {c: _terms(*t) for c, t in table.items()}

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(m: pd.Series, r: pd.Series, channel: pd.Series) -> pd.Series:
        """Full coefficient grid (x power major); powers that are not fitted stay 0."""
        made = []
        for mm, rr, ch in zip(m, r, channel):
            terms = wanted.get(ch, wanted.get(None))
            grid = np.asarray(mm).reshape(2 * ax + 1, 2 * ay + 1)
            rhs = np.asarray(rr).reshape(ax + 1, ay + 1)
            a = np.array([[grid[i + p, j + q] for p, q in terms] for i, j in terms])
            c = np.linalg.lstsq(a, np.array([rhs[i, j] for i, j in terms]), rcond=None)[0]
            full = np.zeros((ax + 1, ay + 1))
            for (i, j), v in zip(terms, c):
                full[i, j] = v
            made.append(full.ravel())
        return pd.Series(made)

    channel = F.col("channel") if "channel" in keys else F.lit(-1)
    coef = sums.select(*keys, "height", "width", solve("m", "r", channel).alias("c"))
    return coef.select(*keys, "height", "width", F.posexplode("c").alias("pos", "coef")).select(
        *keys, "height", "width", F.floor(F.col("pos") / (ay + 1)).cast("int").alias("i"),
        (F.col("pos") % (ay + 1)).alias("j"), "coef")


def polyfit_surface(background: DataFrame, kx: Degree = 3, ky: Degree = 3, order=None,
                    keys: Sequence[str] = ("channel",)) -> DataFrame:
    """The fitted surface at every pixel of the background, evaluated by named x and y."""
    coef = polyfit(background, kx, ky, order, keys)
    packed = coef.groupBy(*keys, "height", "width").agg(
        F.collect_list(F.struct("i", "j", "coef")).alias("_c"))
    b = background.drop("value").join(packed, list(keys)).withColumns(
        {"_u": _scaled("x", F.col("width")), "_v": _scaled("y", F.col("height"))})
    value = F.aggregate("_c", F.lit(0.0), lambda acc, c: acc + c["coef"]
                        * F.pow(F.col("_u"), c["i"]) * F.pow(F.col("_v"), c["j"]))
    return b.withColumn("value", value).select(*background.columns)


def fit_background(background: DataFrame, method: str = "polyfit", keys: Sequence[str] = ("channel",),
                   **settings) -> DataFrame:
    """Smooth background per strategy key: polynomial surface or rolling ball.

    ``radius``, ``smooth`` and ``white_background`` of the rolling ball are numbers, or tables by channel.
    """
    if method == "polyfit":
        return polyfit_surface(background, keys=keys, **settings)
    if method == "simple" and any(isinstance(settings.get(k), Mapping) for k in ("radius", "smooth", "white_background")):
        table = {k: v if isinstance(v, Mapping) else {None: v} for k, v in settings.items() if k in ("radius", "smooth", "white_background")}
        rest = {k: v for k, v in settings.items() if k not in table}
        radius = table.pop("radius", {None: 50})
        return rolling_ball_per_channel(background, radius, keys=keys, **table, **rest).select(*background.columns)
    if method == "simple":
        return rolling_ball(background, keys=keys, **settings).select(*background.columns)
    raise ValueError("method must be polyfit or simple")


# --- correction ---------------------------------------------------------------------------

def scale_background(background: DataFrame, rescale: str | None = None, offset: float = 0.0,
                     offset_background: bool = False, epsilon: float = 1e-8,
                     keys: Sequence[str] = ("channel",), strict: bool = True) -> DataFrame:
    """Offset, then rescale the background of each group, before it meets any pixel."""
    if rescale not in (None, "max", "minmax"):
        raise ValueError("rescale must be None, 'max' or 'minmax'")
    v = F.col("value")
    if offset_background:
        if strict and offset > 0:
            v = F.when(v < offset, F.raise_error(F.lit("offset exceeds the background minimum")).cast("double")).otherwise(v)
        v = v - F.lit(float(offset))
    b = background.withColumn("value", v)
    if rescale is None:
        return b
    lo, hi = F.col("_lo"), F.col("_hi")
    # A literal key stands in where the whole background is one group.
    group = list(keys) or ["_all"]
    b = b if keys else b.withColumn("_all", F.lit(0))
    stats = b.groupBy(*group).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    if rescale == "max":
        scaled = F.col("value") / (hi + F.lit(epsilon))
    else:
        flat = F.raise_error(F.lit("cannot min-max scale a constant background")).cast("double") if strict else F.lit(None).cast("double")
        scaled = F.when(hi == lo, flat).otherwise((F.col("value") - lo) / (hi - lo + F.lit(epsilon)))
    return b.join(stats, group).withColumn("value", scaled).select(*background.columns)


def correct_pixels(pixels: DataFrame, background: DataFrame, method: str = "subtraction",
                   offset: float = 0.0, epsilon: float = 1e-8, rescale: str | None = None,
                   offset_background: bool = False, clip: bool = False, clip_min: float | None = 0.0,
                   clip_max: float | None = None, dtype: str | None = None,
                   condition: Sequence[str] = (), per_channel: bool = True, strict: bool = True) -> DataFrame:
    """Background-corrected pixels.

    Background rows are prepared per (condition, channel) and joined on (condition, channel,
    y, x). With a background below the broadcast threshold of the session the pixels are not
    shuffled. ``strict`` raises on the offending row; without it every pixel is kept, with a
    NULL value where it has no background, and ``correction_violations`` reports it.
    """
    if epsilon <= 0:
        raise ValueError("epsilon must be positive")
    if method not in ("subtraction", "division"):
        raise ValueError("method must be subtraction or division")
    group = [*condition, "channel"] if per_channel else list(condition)
    bg = scale_background(background, rescale, offset, offset_background, epsilon, group, strict)
    bg = bg.select(*condition, *CYX, F.col("value").alias("_bg"))
    px = pixels.join(bg, [*condition, *CYX], "left")
    v, b = F.col("value"), F.col("_bg")
    if strict:
        bad = F.raise_error(F.lit("pixel without a finite value or background")).cast("double")
        b = F.when(b.isNull() | v.isNull(), bad).otherwise(b)
        if method == "division" and offset > 0:
            low = F.raise_error(F.lit("offset must be below the smallest pixel value")).cast("double")
            v = F.when(v <= offset, low).otherwise(v)
    o = F.lit(float(offset))
    out = v - b - o if method == "subtraction" else F.try_divide(v - o, b + F.lit(epsilon))
    if clip:
        out = clip_cast(out, clip_min, clip_max)
    return px.withColumn("value", out.cast(dtype) if dtype else out).drop("_bg")


def correction_violations(pixels: DataFrame, background: DataFrame, method: str = "subtraction",
                          offset: float = 0.0, rescale: str | None = None, offset_background: bool = False,
                          condition: Sequence[str] = (), keys: Sequence[str] = ("image_id", "channel")) -> DataFrame:
    """(image, channel) pairs that break a precondition of the correction, with the counts."""
    bg_keys = [*condition, "channel"]
    stats = background.groupBy(*bg_keys).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    bg = background.join(stats, bg_keys).select(*condition, *CYX, F.col("value").alias("_bg"), "_lo", "_hi")
    px = pixels.join(bg, [*condition, *CYX], "left")
    checks = {"no_background": F.col("_bg").isNull(), "no_value": F.col("value").isNull(),
              "flat_background": F.col("_lo") == F.col("_hi") if rescale == "minmax" else F.lit(False),
              "offset_above_background": (F.col("_lo") < offset) if offset_background else F.lit(False),
              "offset_above_pixel": (F.col("value") <= offset) if method == "division" and offset > 0 else F.lit(False)}
    counts = px.groupBy(*keys).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    return counts.where(" or ".join(f"{n} > 0" for n in checks))


def diagonal_profile(before: DataFrame, after: DataFrame, width: int) -> DataFrame:
    """Values on both diagonals before and after a correction."""
    on = ["image_id", *CYX]
    diagonal = F.array_compact(F.array(F.when(F.col("y") == F.col("x"), F.lit("main")),
                                       F.when(F.col("x") == F.lit(width - 1) - F.col("y"), F.lit("anti"))))

    def pick(df: DataFrame) -> DataFrame:
        # Filter before the join: only 2 of every w pixels of a row lie on a diagonal.
        return df.where((F.col("y") == F.col("x")) | (F.col("x") == F.lit(width - 1) - F.col("y")))

    return (pick(before).select(*on, F.col("value").alias("before"))
            .join(pick(after).select(*on, F.col("value").alias("after")), on)
            .withColumn("diagonal", F.explode(diagonal)))
