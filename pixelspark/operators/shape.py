"""Shape features of labelled objects."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pixelspark.operators.blocks import BLOCK, reduce_blocks, spread, whole_tiles
from pixelspark.operators.fused import moments
from pixelspark.operators.outline import ITEMS, VERTEX, holes, hulls, label_items
from pixelspark.schema import IL

# Variance of a unit pixel, added to the second moments of an object.
PIXEL_VARIANCE = 1.0 / 12.0


def shape_moments(labels: DataFrame, keys: Sequence[str] = tuple(IL),
                  pixel_variance: float = PIXEL_VARIANCE) -> DataFrame:
    """Area, box, centroid, axes, eccentricity and orientation from one pass of sums.

    Moments are rounded to nine digits: an axis-aligned object has a covariance of exactly 0, and
    summation noise must not choose the sign of its orientation.
    """
    y, x = F.col("y"), F.col("x")
    s = labels.where("label > 0").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("area"), F.avg(y).alias("centroid-0"), F.avg(x).alias("centroid-1"),
        *[F.round(m, 9).alias(n) for n, m in (("_yy", F.var_pop(y)), ("_xx", F.var_pop(x)), ("_xy", F.covar_pop(y, x)))],
        F.min(y).alias("bbox-0"), F.min(x).alias("bbox-1"),
        (F.max(y) + 1).alias("bbox-2"), (F.max(x) + 1).alias("bbox-3"))
    a, c, b = F.col("_yy") + pixel_variance, F.col("_xx") + pixel_variance, F.col("_xy")
    root = F.sqrt(((a - c) / 2) * ((a - c) / 2) + b * b)
    l1, l2 = (a + c) / 2 + root, F.greatest((a + c) / 2 - root, F.lit(0.0))
    box = ((F.col("bbox-2") - F.col("bbox-0")) * (F.col("bbox-3") - F.col("bbox-1"))).cast("bigint")
    quarter = F.lit(math.pi / 4)
    orientation = F.when(F.abs(a - c) < 1e-12, F.when(b > 0, quarter).otherwise(-quarter)) \
        .otherwise(F.atan2(2 * b, a - c) / 2)
    return s.select(
        *keys, "area", "centroid-0", "centroid-1", "bbox-0", "bbox-1", "bbox-2", "bbox-3",
        box.alias("area_bbox"), (F.col("area") / box).alias("extent"),
        F.sqrt(F.col("area") * (4 / math.pi)).alias("equivalent_diameter_area"),
        (F.sqrt(l1) * 4).alias("axis_major_length"), (F.sqrt(l2) * 4).alias("axis_minor_length"),
        F.coalesce(F.sqrt(F.lit(1.0) - F.try_divide(l2, l1)), F.lit(0.0)).alias("eccentricity"),
        orientation.alias("orientation"))


def quad_counts(labels: DataFrame, keys: Sequence[str] = tuple(IL)) -> DataFrame:
    """Number of 2x2 windows per pattern code and object.

    Each pixel adds one bit to the four windows it belongs to; the bits of one window sum up
    to its code. Bit 1 is the lower right, 2 the upper right, 4 the lower left, 8 the upper
    left pixel of the window.
    """
    quads = F.array(*[F.struct((F.col("y") + dy).alias("qy"), (F.col("x") + dx).alias("qx"),
                               F.lit(bit).alias("bit"))
                      for dy, dx, bit in ((0, 0, 1), (1, 0, 2), (0, 1, 4), (1, 1, 8))])
    codes = (labels.where("label > 0").select(*keys, F.inline(quads))
             .groupBy(*keys, "qy", "qx").agg(F.sum("bit").cast("int").alias("code")))
    return codes.groupBy(*keys, "code").agg(F.count(F.lit(1)).alias("n"))


def _code_sum(weights: Sequence[float]) -> Column:
    w = F.array(*[F.lit(float(v)) for v in weights])
    return F.sum(F.element_at(w, F.col("code") + 1) * F.col("n"))


_R2 = math.sqrt(2.0)
# Line-count weights of the Crofton perimeter with four directions, by code.
CROFTON_4 = (0.0, math.pi / 4 * (1 + 1 / _R2), math.pi / (4 * _R2), math.pi / (2 * _R2),
             0.0, math.pi / 4 * (1 + 1 / _R2), 0.0, math.pi / (4 * _R2),
             math.pi / 4, math.pi / 2, math.pi / (4 * _R2), math.pi / (4 * _R2),
             math.pi / 4, math.pi / 2, 0.0, 0.0)


def _euler_weights(connectivity: int) -> list[float]:
    diagonal = -2 if connectivity == 8 else 2
    by_count = {1: 1, 3: -1}
    return [(diagonal if code in (6, 9) else by_count.get(bin(code).count("1"), 0)) / 4 for code in range(16)]


def topology(labels: DataFrame, keys: Sequence[str] = tuple(IL), connectivity: int = 8) -> DataFrame:
    """Euler number and Crofton perimeter from the pattern counts."""
    return quad_counts(labels, keys).groupBy(*keys).agg(
        F.round(_code_sum(_euler_weights(connectivity))).cast("int").alias("euler_number"),
        _code_sum(CROFTON_4).alias("perimeter_crofton"))


def perimeter_weights(a: np.ndarray) -> np.ndarray:
    """What each pixel of a tile of labels (the last two axes) adds to the perimeter of its object; reaches two pixels far.

    A border pixel weighs 1, sqrt(2) or their mean by how it touches other border pixels (4-neighbour border).
    """
    p = np.pad(a, ((0, 0),) * (a.ndim - 2) + ((2, 2), (2, 2)))

    def at(src, dy, dx, margin):
        h, w = src.shape[-2:]
        return src[..., margin + dy:h - margin + dy, margin + dx:w - margin + dx]

    inner = at(p, 0, 0, 1)
    border = np.zeros(inner.shape, bool)
    for dy, dx in ((-1, 0), (1, 0), (0, -1), (0, 1)):
        border |= at(p, dy, dx, 1) != inner
    border &= inner > 0
    line = np.where(border, inner, 0)
    here = at(line, 0, 0, 1)
    straight = sum((at(line, dy, dx, 1) == here) for dy, dx in ((-1, 0), (1, 0), (0, -1), (0, 1)))
    diagonal = sum((at(line, dy, dx, 1) == here) for dy, dx in ((-1, -1), (-1, 1), (1, -1), (1, 1)))
    code = 1 + 2 * straight + 10 * diagonal
    value = np.select([np.isin(code, (5, 7, 15, 17, 25, 27)), np.isin(code, (21, 33)),
                       np.isin(code, (13, 23))], [1.0, math.sqrt(2), (1 + math.sqrt(2)) / 2], 0.0)
    return np.where(here > 0, value, 0.0)


def perimeter(labels: DataFrame, keys: Sequence[str] = tuple(IL), block: int = BLOCK) -> DataFrame:
    """Length of the line through the centres of the border pixels; tiles return one sum for each object."""
    group = [k for k in keys if k != "label"]
    px = labels.where("label > 0").select(*group, "y", "x", F.col("label").cast("double").alias("label"))

    def kernel(a: np.ndarray, core: tuple[slice, slice]) -> list[np.ndarray]:
        label, n, mean, *_ = moments(a[core], perimeter_weights(a)[core])
        return [label, n * mean]

    parts = reduce_blocks(px, kernel, "label int, w double", values=["label"], keys=group, halo=2, fill=[0.0], block=block)
    return parts.groupBy(*keys).agg(F.sum("w").alias("perimeter"))


def outlines(labels: DataFrame, keys: Sequence[str] = tuple(IL), block: int = BLOCK) -> DataFrame:
    """(keys, area_convex, feret_diameter_max, holes) of each object.

    Tiles reduce their objects to hull vertices and runs of background along the tile border; a task that puts an object together
    holds these, not its pixels. The hull runs through the midpoints of the pixel sides; a pixel counts when its centre lies
    inside or on it. A hole is background that no 8-connected path leads out of.
    """
    keys, group = list(keys), [k for k in keys if k != "label"]
    px = labels.where("label > 0").select(*group, "y", "x", F.col("label").cast("double").alias("label"))
    items = reduce_blocks(px, lambda a, core, origin: label_items(a[core], *origin), ITEMS, values=["label"], keys=group, fill=[0.0], block=block, place=True)
    rows = spread(items, *keys).sortWithinPartitions(*keys)
    schema = T.StructType([*rows.select(*keys).schema.fields, T.StructField("area_convex", T.LongType()), T.StructField("feret_diameter_max", T.DoubleType()),
                           T.StructField("holes", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_tiles(batches, keys):
            col = {c: table.column(c).to_numpy().astype(np.int64) for c in ("ty", "tx", "kind", "a", "b", "c", "n")}
            of, vertex = np.searchsorted(starts, np.arange(table.num_rows), "right") - 1, col["kind"] == VERTEX
            made = hulls(of[vertex], col["a"][vertex], col["b"][vertex])
            tile, hole = np.stack([col["ty"], col["tx"]], 1), []
            for i, (a, b) in enumerate(zip(starts, [*starts[1:], table.num_rows])):
                part = a + np.flatnonzero(~vertex[a:b])
                hole.append(holes(tile[part], *[col[c][part] for c in ("kind", "a", "b", "c", "n")], block))
            data = [table.column(k).take(pa.array(starts)).combine_chunks().cast(f.type) for k, f in zip(keys, arrow)]
            data += [pa.array([made[i][j] for i in range(len(starts))], t) for j, t in ((0, pa.int64()), (1, pa.float64()))]
            yield pa.RecordBatch.from_arrays([*data, pa.array(hole, pa.int64())], schema=arrow)

    return rows.mapInArrow(run, schema)


def _area(labels: DataFrame, keys: Sequence[str]) -> DataFrame:
    return labels.where("label > 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("area"))


def hull_features(labels: DataFrame, keys: Sequence[str] = tuple(IL), block: int = BLOCK) -> DataFrame:
    """Convex area, solidity and largest Feret diameter, see ``outlines``."""
    return _area(labels, keys).join(outlines(labels, keys, block), list(keys)).select(
        *keys, "area_convex", (F.col("area") / F.col("area_convex")).alias("solidity"), "feret_diameter_max")


def filled_area(labels: DataFrame, keys: Sequence[str] = tuple(IL), block: int = BLOCK) -> DataFrame:
    """Area with holes filled; a hole is background not connected (8 ways) to the outside, see ``outlines``."""
    return _area(labels, keys).join(outlines(labels, keys, block), list(keys)).select(*keys, (F.col("area") + F.col("holes")).alias("area_filled"))


def object_shape(labels: DataFrame, keys: Sequence[str] = tuple(IL), found: DataFrame | None = None) -> DataFrame:
    """All shape features of an object side by side.

    ``found`` has perimeter, area_convex, feret_diameter_max and holes of each object where another pass over the tiles gave them.
    """
    out = shape_moments(labels, keys).join(topology(labels, keys), list(keys), "left")
    for part in [found] if found is not None else [perimeter(labels, keys), outlines(labels, keys)]:
        out = out.join(part, list(keys), "left")
    return out.withColumns({"solidity": F.col("area") / F.col("area_convex"), "area_filled": F.col("area") + F.col("holes")}).drop("holes")
