"""Aggregate statistics as factories ``value -> aggregate column``.

All factories but ``quantile``/``median`` keep a fixed-size buffer, so Spark combines them on
the map side and a hot group costs no more than any other. ``quantile`` keeps one counter
per distinct value: use it where the number of grey levels is bounded, and
``operators.ranking.percentiles`` where it is not.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

Stat = Callable[[Column], Column]


def mean(v: Column) -> Column:
    return F.avg(v)


def std(v: Column) -> Column:
    """Population standard deviation."""
    return F.stddev_pop(v)


def mean_over_std(v: Column) -> Column:
    """Mean divided by population standard deviation; NULL for a constant group."""
    return F.try_divide(F.avg(v), F.nullif(F.stddev_pop(v), F.lit(0.0)))


def skew(v: Column) -> Column:
    """Population skewness m3/m2^1.5; NULL for a constant group."""
    return F.skewness(v)


def total(v: Column) -> Column:
    return F.sum(v)


def quantile(q: float) -> Stat:
    """Linear-interpolated quantile of a bounded set of levels; ``measure.image_stat`` and ``ranking.percentiles`` set no bound."""
    if not 0.0 <= q <= 1.0:
        raise ValueError("a quantile lies in [0, 1]")
    return lambda v: F.percentile(v, q)


def approx_quantile(q: float, accuracy: int = 10_000) -> Stat:
    return lambda v: F.percentile_approx(v, q, accuracy)


median: Stat = quantile(0.5)


def pearson(a: Column, b: Column) -> Column:
    """Correlation that is NULL, not an error, for a constant side."""
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    scale = F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))
    return F.try_divide(F.covar_pop(a, b), scale)


STATS: Mapping[str, Stat] = {
    "mean": mean,
    "std": std,
    "min": F.min,
    "max": F.max,
    "sum": total,
    "skew": skew,
    "median": median,
    "q25": quantile(0.25),
    "q75": quantile(0.75),
    "mean_over_std": mean_over_std,
    "variance": F.var_pop,
}


def resolve(stat: str | Stat) -> Stat:
    """A registered statistic by name, or the caller's own factory."""
    return STATS[stat] if isinstance(stat, str) else stat
