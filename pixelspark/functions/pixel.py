"""Arithmetic on a pixel value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def threshold_mask(value: Column, threshold: float = 4000.0) -> Column:
    """1 where the value exceeds the threshold, else 0."""
    return F.when(value > threshold, 1).otherwise(0)


def clip_cast(value: Column, low: float | None = 0.0, high: float | None = None,
              dtype: str | None = None) -> Column:
    """Clip to [low, high], either side optional, then cast."""
    hit = value.isNotNull()
    if low is not None:
        value = F.when(hit, F.greatest(value, F.lit(float(low))))
    if high is not None:
        value = F.when(hit, F.least(value, F.lit(float(high))))
    return value.cast(dtype) if dtype else value


def rescale_levels(value: Column, low: Column, high: Column, levels: int = 8,
                   bottom: int = 0) -> Column:
    """Clip to [low, high], stretch to [bottom, levels-1], floor. A flat range gives ``bottom``.

    Nine digits are kept before the floor, so that a value on a level border does not depend on
    the last bit of an interpolated percentile.
    """
    clipped = F.greatest(F.least(value, high), low)
    share = F.try_divide(clipped - low, high - low)
    level = F.floor(F.round(share * F.lit(float(levels - 1 - bottom)) + F.lit(float(bottom)), 9))
    return F.when(value.isNotNull(), F.coalesce(level.cast("int"), F.lit(bottom)))


def minmax(value: Column, low: Column, high: Column) -> Column:
    """(v-min)/(max-min); unchanged where the group is constant."""
    return F.when(high > low, (value - low) / F.nullif(high - low, F.lit(0.0))).otherwise(value)
