"""Label relations: overlap, containment, relabelling, clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelspark.operators.ranking import percentiles
from pixelspark.schema import IL, IMG

PX = ("image_id", "y", "x")


def _present(labels: DataFrame) -> DataFrame:
    return labels.where("label > 0")


def label_pairs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both labels of every pixel stored on either side; a missing one is 0."""
    a = first.select(*PX, F.col("label").alias("label_1"))
    b = second.select(*PX, F.col("label").alias("label_2"))
    return a.join(b, list(PX), "full_outer").fillna(0, ["label_1", "label_2"])


def label_overlap(first: DataFrame, second: DataFrame, include_background: bool = False) -> DataFrame:
    """Pixel count per pair of labels.

    By default only pixels with a positive first label are read, so the sparse mask drives a
    left join; the background of the first mask is added on request.
    """
    if include_background:
        pairs = label_pairs(first, second)
    else:
        a = _present(first).select(*PX, F.col("label").alias("label_1"))
        b = second.select(*PX, F.col("label").alias("label_2"))
        pairs = a.join(b, list(PX), "left").fillna(0, ["label_2"])
    return pairs.groupBy(*IMG, "label_1", "label_2").agg(F.count(F.lit(1)).alias("overlap"))


def label_stack_overlap(stack: DataFrame, planes: Sequence[int], include_background: bool = False) -> DataFrame:
    """Overlap of every pair of planes i < j, with area and centroid of both labels.

    ``stack`` has a ``plane`` column. The planes of a pixel are put side by side in one
    aggregation; each pixel then gives one row per plane pair, not per label pair.
    """
    wide = stack.where(F.col("plane").isin(*planes)).groupBy(*PX).agg(*[
        F.max(F.when(F.col("plane") == p, F.col("label"))).alias(f"p{p}") for p in planes])
    pairs = F.array(*[F.struct(F.lit(i).alias("plane_1"), F.lit(j).alias("plane_2"),
                               F.coalesce(F.col(f"p{i}"), F.lit(0)).alias("label_1"),
                               F.coalesce(F.col(f"p{j}"), F.lit(0)).alias("label_2"))
                      for a, i in enumerate(planes) for j in planes[a + 1:]])
    rows = wide.select(*IMG, F.inline(pairs))
    if not include_background:
        rows = rows.where("label_1 > 0")
    counts = rows.groupBy(*IMG, "plane_1", "plane_2", "label_1", "label_2").agg(
        F.count(F.lit(1)).alias("overlap"))
    geo = label_geometry(stack, [*IMG, "plane", "label"])
    out = counts
    for side in ("1", "2"):
        g = geo.select(*IMG, F.col("plane").alias(f"plane_{side}"), F.col("label").alias(f"label_{side}"),
                       F.col("area").alias(f"area_{side}"), F.col("centroid-0").alias(f"centroid_{side}-0"),
                       F.col("centroid-1").alias(f"centroid_{side}-1"))
        out = out.join(g, [*IMG, f"plane_{side}", f"label_{side}"], "left")
    return out


def stack_overlap_wide(overlap: DataFrame, planes: Sequence[int]) -> DataFrame:
    """One overlap column per plane pair, labels that occur in any pair on the rows."""
    named = [overlap.where((F.col("plane_1") == i) & (F.col("plane_2") == j)).select(
        *IMG, F.col("label_1").alias(f"label_{i}"), F.col("label_2").alias(f"label_{j}"),
        F.col("overlap").alias(f"overlap_{i}_{j}"))
        for a, i in enumerate(planes) for j in planes[a + 1:]]
    out = named[0]
    for part in named[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def label_geometry(labels: DataFrame, keys: Sequence[str] = tuple(IL)) -> DataFrame:
    """Area and centroid per label."""
    return _present(labels).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("area"), F.avg("y").alias("centroid-0"), F.avg("x").alias("centroid-1"))


def secondary_objects(primary: DataFrame, secondary: DataFrame, threshold: float = 0.7,
                      primary_label: int | None = None, name: str = "secondary_object",
                      primary_name: str = "primary_object") -> DataFrame:
    """Objects whose share inside the primary mask exceeds ``threshold``.

    The primary label is the smallest one of the image unless given.
    """
    first = _present(primary).select(*PX, F.col("label").alias("_p"))
    px = _present(secondary).join(first, list(PX), "left")
    table = px.groupBy(*IL).agg(
        F.count(F.lit(1)).alias(f"area_{name}"), F.count("_p").alias(f"area_overlap_{name}"),
        F.avg("y").alias(f"centroid-0_{name}"), F.avg("x").alias(f"centroid-1_{name}"))
    table = table.withColumn(f"area_fraction_{name}", F.col(f"area_overlap_{name}") / F.col(f"area_{name}"))
    table = table.where(F.col(f"area_fraction_{name}") > threshold).withColumnRenamed("label", f"label_{name}")
    column = f"label_{primary_name}"
    if primary_label is not None:
        return table.withColumn(column, F.lit(primary_label))
    lowest = first.groupBy(*IMG).agg(F.min("_p").alias(column))
    return table.join(lowest, IMG, "left")


def keep_labels(labels: DataFrame, keep: DataFrame, label: str = "label") -> DataFrame:
    """Pixels of the labels listed in ``keep``."""
    return labels.join(keep.select(*IMG, F.col(label).alias("label")), IL, "left_semi")


def drop_labels(labels: DataFrame, drop: DataFrame, label: str = "label") -> DataFrame:
    return labels.join(drop.select(*IMG, F.col(label).alias("label")), IL, "left_anti")


def _best_container(container: DataFrame, contained: DataFrame) -> DataFrame:
    """Overlap with each container per contained label, reduced to the largest overlap."""
    overlap = label_overlap(contained, container).withColumnsRenamed(
        {"label_1": "label", "label_2": "container"})
    inside = F.col("container") > 0
    rank = F.struct("overlap", (-F.col("container")).alias("c"))
    return overlap.groupBy(*IL).agg(
        F.count_if(inside).alias("n_containers"),
        F.max_by("container", F.when(inside, rank)).alias("container"))


def match_mapping(container: DataFrame, contained: DataFrame) -> DataFrame:
    """Contained label, its container and what happened to it.

    The container with the largest overlap wins, equal overlaps go to the smaller label. A
    container goes to its smallest contained label; later ones are skipped.
    """
    best = _best_container(container, contained)
    owner = best.where("n_containers > 0").groupBy(*IMG, "container").agg(F.min("label").alias("_owner"))
    status = (F.when(F.col("n_containers") == 0, "outside")
              .when(F.col("_owner") != F.col("label"), "taken")
              .when(F.col("n_containers") > 1, "several").otherwise("single"))
    return (best.join(owner, [*IMG, "container"], "left")
            .select(*IL, "container", "n_containers", status.alias("status")))


def match_violations(container: DataFrame, contained: DataFrame) -> DataFrame:
    """What strict matching rejects: outside, several containers, container already taken."""
    return match_mapping(container, contained).where("status <> 'single'")


def match_labels(container: DataFrame, contained: DataFrame, strict: bool = False) -> DataFrame:
    """Contained pixels relabelled by their container; objects without one vanish."""
    mapping = match_mapping(container, contained)
    if strict:
        ok = F.col("status") == "single"
        mapping = mapping.withColumn("status", F.when(ok, F.col("status")).otherwise(
            F.raise_error(F.concat(F.lit("label violates one-to-one containment: "), F.col("label")))))
    mapping = mapping.where(F.col("status").isin("single", "several"))
    return (_present(contained).join(mapping.select(*IL, "container"), IL)
            .select(*PX, F.col("container").alias("label")))


def edge_labels(labels: DataFrame, shape: DataFrame) -> DataFrame:
    """Labels that touch the first or last row or column.

    Objects are reduced to their extremes first; the image shape is joined to objects, not pixels.
    """
    box = _present(labels).groupBy(*IL).agg(*[f(c).alias(f"_{c}{n}") for c in ("y", "x")
                                              for n, f in (("0", F.min), ("1", F.max))])
    at_edge = (F.col("_y0") == 0) | (F.col("_x0") == 0) | (F.col("_y1") == F.col("height") - 1) \
        | (F.col("_x1") == F.col("width") - 1)
    return box.join(shape.select(*IMG, "height", "width"), IMG).where(at_edge).select(*IL)


def exclude_edge_labels(labels: DataFrame, shape: DataFrame) -> DataFrame:
    return drop_labels(_present(labels), edge_labels(labels, shape))


def filter_area(labels: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """Pixels of objects whose area lies in [low, high]."""
    area = _present(labels).groupBy(*IL).agg(F.count(F.lit(1)).alias("area"))
    keep = F.lit(True)
    if low is not None:
        keep &= F.col("area") >= low
    if high is not None:
        keep &= F.col("area") <= high
    return keep_labels(_present(labels), area.where(keep))


def drop_unpaired(cells: DataFrame, nuclei: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells that hold a nucleus pixel and nuclei that lie on a cell."""
    pairs = label_overlap(cells, _present(nuclei)).where("label_2 > 0")
    return keep_labels(_present(cells), pairs, "label_1"), keep_labels(_present(nuclei), pairs, "label_2")


def confine_contained(cells: DataFrame, nuclei: DataFrame) -> DataFrame:
    """Nucleus pixels inside a cell, carrying the label of that cell."""
    on_cell = _present(cells).select(*PX, F.col("label").alias("_cell"))
    return _present(nuclei).join(on_cell, list(PX)).select(*PX, F.col("_cell").alias("label"))


def drop_saturated(pixels: DataFrame, low: float, high: float) -> DataFrame:
    """Pixels that are neither the lowest nor the highest value of the data type; NULL values are kept."""
    return pixels.where(~F.coalesce(F.col("value").isin(float(low), float(high)), F.lit(False)))


def subtract_mask(labels: DataFrame, remove: DataFrame) -> DataFrame:
    """Cytosol: pixels of the first mask outside the second."""
    return _present(labels).join(_present(remove).select(*PX), list(PX), "left_anti")


def background_offset(pixels: DataFrame, masks: DataFrame) -> DataFrame:
    """Median per (image, channel) of the pixels outside all masks."""
    outside = pixels.join(_present(masks).select(*PX), list(PX), "left_anti")
    return percentiles(outside, [*IMG, "channel"], "value", {"offset": 0.5})


def distinct_labels(labels: DataFrame, keys: Sequence[str] = tuple(IMG)) -> DataFrame:
    """Number of objects per image."""
    return _present(labels).groupBy(*keys).agg(F.countDistinct("label").alias("n_labels"))


def object_loss(before: DataFrame, after: DataFrame) -> DataFrame:
    """Objects before and after a step such as erosion, per image."""
    both = (_present(before).select(*IL, F.lit(1).alias("b"), F.lit(0).alias("a"))
            .unionByName(_present(after).select(*IL, F.lit(0).alias("b"), F.lit(1).alias("a"))))
    per = both.groupBy(*IL).agg(F.max("b").alias("b"), F.max("a").alias("a"))
    return per.groupBy(*IMG).agg(F.sum("b").alias("n_before"), F.sum("a").alias("n_after"))


def lost_labels(before: DataFrame, after: DataFrame) -> DataFrame:
    return _present(before).select(*IL).distinct().join(_present(after).select(*IL), IL, "left_anti")
