"""Ranks, order statistics and exact-count selection without a group in one task.

A window over a whole group would sort that group in a single task. Here each group is cut
into ordered buckets first: rows are numbered inside a bucket and the bucket totals give the
offset to add. A group of any size is spread over its buckets: those of values are steps of the
order code, so their number follows the data; those of random keys are as many as the counted
size of the group asks for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Steps of the order code between a number and its double: for selection, and where every bucket is read again.
STEPS, RANK_STEPS = 4096, 512
#: Rows that a bucket of a random key should hold.
BUCKET_ROWS = 2000
#: Parts that a few rows per group are copied to where they meet all rows of the group.
SALT = 16
#: Rows of a group up to which one task may hold it whole.
GROUP_ROWS = 1 << 16


def order_code(v: Column, steps: int = STEPS) -> Column:
    """A whole number that never falls where the value rises: sign and binary logarithm, ``steps`` to an octave; NaN is highest."""
    v = v.cast("double")
    step = F.floor(F.log2(F.abs(v)) * steps) + 2000 * steps
    far = F.when(F.abs(v) == float("inf"), F.lit(4000 * steps)).otherwise(step).cast("bigint")
    return F.when(F.isnan(v), F.lit(5000 * steps).cast("bigint")).when(v == 0, F.lit(0).cast("bigint")).when(v > 0, far).otherwise(-far)


def with_bounds(df: DataFrame, bounds: DataFrame, keys: Sequence[str], by: Column) -> DataFrame:
    """Rows with the few values of their group, one row in ``bounds``; NULL keys match each other.

    Where the planner does not broadcast the bounds, they are copied to SALT parts, and the rows of a group are dealt to
    these by the hash of ``by``, so that no task holds a whole group.
    """
    key = [f"_key_{i}" for i in range(len(keys))]
    few = bounds.select(*[F.col(k).alias(n) for k, n in zip(keys, key)], *[c for c in bounds.columns if c not in keys],
                        F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("_part"))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, key)]
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALT)).cast("int"))
    return dealt.join(few, [*same, F.col("_salt") == F.col("_part")]).drop(*key, "_salt", "_part")


def large_groups(rows: DataFrame, keys: Sequence[str], most: int | None = None) -> DataFrame:
    """The keys of groups with more than ``most`` (GROUP_ROWS) rows: at most one for so many rows of the data."""
    most = GROUP_ROWS if most is None else most
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > most).select(*keys)


def of_groups(df: DataFrame, groups: DataFrame, inside: bool) -> DataFrame:
    """Rows whose group is (not) among the few ``groups``, which are sent to all tasks; NULL keys match each other."""
    keys = groups.columns
    few = F.broadcast(groups.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]))
    return df.join(few, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)], "left_semi" if inside else "left_anti")


def tile_of(*coordinates: str) -> Column:
    """What rows of one tile have in common."""
    return F.concat_ws(",", *[F.floor(F.col(c) / 256).cast("string") for c in coordinates])


def value_counts(df: DataFrame, keys: Sequence[str], value: str = "value", out: str = "n") -> DataFrame:
    """Distinct values of each group with their counts; combined before the shuffle."""
    return (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
            .agg(F.count(F.lit(1)).alias(out)))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], weight: Column,
                bucket: str, out: str) -> DataFrame:
    """Sum of ``weight`` (not negative) over all earlier rows of the group, plus the group total.

    ``bucket`` must be monotone in ``order``. The bucket totals are read off the numbered rows,
    which are already partitioned by bucket. A bucket that cannot be NULL keeps both reads of
    the rows identical, so Spark runs their shuffle once.
    """
    before = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    rows = df.withColumn("_in", F.coalesce(F.sum(weight).over(before), F.lit(0)))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = (rows.groupBy(*keys, bucket).agg(F.max(F.col("_in") + weight).alias("_w"))
               .withColumn("_off", F.coalesce(F.sum("_w").over(earlier), F.lit(0)))
               .withColumn(f"{out}_total", F.sum("_w").over(whole)).drop("_w"))
    return (rows.join(offsets, [*keys, bucket])
            .withColumn(out, F.col("_in") + F.col("_off")).drop("_in", "_off"))


def value_ranks(df: DataFrame, keys: Sequence[str], value: str = "value",
                weight: str | None = None) -> DataFrame:
    """(keys, value, n, below, below_total) per distinct value of each group.

    ``below`` counts the rows with a smaller value. Buckets are steps of the order code, so a group
    holding a third of the data is cut by its values; no pass is needed to find the cuts.
    """
    if weight is None:
        counts = value_counts(df, keys, value)
    else:
        counts = (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
                  .agg(F.sum(weight).alias("n")))
    counts = counts.withColumn("_bucket", F.coalesce(order_code(F.col(value), RANK_STEPS), F.lit(0).cast("bigint")))
    return running_sum(counts, keys, [value], F.col("n"), "_bucket", "below").drop("_bucket")


def percentiles(df: DataFrame, keys: Sequence[str], value: str, qs: Mapping[str, float],
                weight: str | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles, one named column per entry of ``qs``; in fixed memory, whatever the values.

    Groups of at most GROUP_ROWS rows are dealt by group once and put in order there. Of larger ones distinct values are counted,
    spread over all tasks by (group, value), and put in order within each order code; the totals of the codes, a few thousand
    rows per octave of values and group, give what lies below. So no task sorts a large group.
    """
    if any(not 0.0 <= q <= 1.0 for q in qs.values()):
        raise ValueError("quantiles lie in [0, 1]")
    df = df.where(F.col(value).isNotNull())
    if not keys:
        return _percentiles_spread(df, keys, value, qs, weight)
    many = large_groups(df, keys)
    return _percentiles_whole(of_groups(df, many, False), keys, value, qs, weight).unionByName(
        _percentiles_spread(of_groups(df, many, True), keys, value, qs, weight))


def _percentiles_whole(df: DataFrame, keys: Sequence[str], value: str, qs: Mapping[str, float], weight: str | None) -> DataFrame:
    n = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    rows = df.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], F.col(value).alias("_v"), n.alias("_n"))
    whole = Window.partitionBy(*[f"_key_{i}" for i in range(len(keys))])
    before = whole.orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranks = rows.withColumn("_below", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_below_total", F.sum("_n").over(whole))
    aggs, out = _quantile_columns(qs)
    found = ranks.groupBy(*[f"_key_{i}" for i in range(len(keys))]).agg(*aggs)
    return found.select(*[F.col(f"_key_{i}").alias(k) for i, k in enumerate(keys)], *out)


def _percentiles_spread(df: DataFrame, keys: Sequence[str], value: str, qs: Mapping[str, float], weight: str | None) -> DataFrame:
    counts = value_counts(df, keys, value) if weight is None else (
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("n")))
    # the keys in one struct, which is never NULL, and a code that is not either: both reads of the counts stay alike
    counts = counts.select(F.struct(*keys).alias("_g"), F.col(value).alias("_v"), F.col("n").alias("_n"),
                           F.coalesce(order_code(F.col(value)), F.lit(0).cast("bigint")).alias("_code"))
    ranks = running_sum(counts, ["_g"], ["_v"], F.col("_n"), "_code", "_below")
    aggs, out = _quantile_columns(qs)
    return ranks.groupBy("_g").agg(*aggs).select("_g.*", *out)


def whole_values(df: DataFrame, keys: Sequence[str], value: str, out: str, *aggs: Column) -> DataFrame:
    """(keys, array of the values in order, further aggregates) of groups of at most GROUP_ROWS rows; NULL does not count."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias(out), *aggs)


def array_quantile(v: Column, q: float) -> Column:
    """Linear-interpolated quantile of an array in order; NULL for an empty one."""
    pos = F.lit(q) * (F.size(v) - 1)
    a, b = (F.get(v, at.cast("int")) for at in (F.floor(pos), F.ceil(pos)))
    return F.when(a == b, a).otherwise(a + (pos - F.floor(pos)) * (b - a)).cast("double")


def _quantile_columns(qs: Mapping[str, float]) -> tuple[list[Column], list[Column]]:
    """Aggregates of ranked values, and the quantiles formed from them."""
    aggs, out = [], []
    for i, (name, q) in enumerate(qs.items()):
        pos = F.lit(q) * (F.col("_below_total") - 1)
        for tag, k in ((f"_lo{i}", F.floor(pos)), (f"_hi{i}", F.ceil(pos))):
            hit = (F.col("_below") <= k) & (k < F.col("_below") + F.col("_n"))
            aggs.append(F.max(F.when(hit, F.col("_v"))).alias(tag))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"_f{i}"))
        a, b = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append(F.when(a == b, a).otherwise(a + F.col(f"_f{i}") * (b - a)).cast("double").alias(name))
    return aggs, out


def average_rank(df: DataFrame, keys: Sequence[str], value: str = "value", out: str = "rank") -> DataFrame:
    """Attach the 1-based mid-rank of each row in its group; ties share the mean rank."""
    ranks = value_ranks(df, keys, value).select(
        *keys, value, (F.col("below") + (F.col("n") + 1) / 2).alias(out))
    return df.join(ranks, [*keys, value], "left")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], bucket: Column,
             out: str = "rn") -> DataFrame:
    """1-based row number inside each group plus ``{out}_total``; ``bucket`` follows ``order``."""
    rows = running_sum(df.withColumn("_bucket", bucket), keys, order, F.lit(1), "_bucket", out)
    return rows.withColumn(out, F.col(out) + 1).drop("_bucket")


def random_order(*parts: Column, seed: int) -> Column:
    """Reproducible random sort key: the md5 text of the row key and the seed."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed))))


def random_bucket(h: str, rows: Column) -> Column:
    """The leading hex digits of a random key, as many as cut ``rows`` rows into buckets of about BUCKET_ROWS."""
    digits = F.greatest(F.lit(0), F.ceil(F.log2(rows / F.lit(BUCKET_ROWS)) / 4)).cast("int")
    return F.coalesce(F.substr(F.col(h), F.lit(1), digits), F.lit(""))


def random_numbered(df: DataFrame, key: Sequence[str], seed: int, out: str = "rn") -> DataFrame:
    """Number all rows in a reproducible random order; the rows are counted for the number of buckets."""
    total = df.agg(F.count(F.lit(1))).scalar()
    df = df.withColumn("_h", random_order(*[F.col(k) for k in key], seed=seed))
    df = df.withColumn("_all", F.lit(0))
    rows = numbered(df, ["_all"], ["_h", *key], random_bucket("_h", total), out)
    return rows.drop("_h", "_all")
