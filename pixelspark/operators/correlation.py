"""Correlation of channels inside objects, observed and under permutation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pixelspark.operators.blocks import spread, whole_tiles
from pixelspark.operators.ranking import (RANK_STEPS, large_groups, numbered, of_groups, order_code, random_bucket, running_sum, tile_of,
                                          value_ranks, with_bounds)
from pixelspark.schema import IL, IMG

G = [*IL, "channel_1", "channel_2"]


def channel_pairs(pixels: DataFrame, labels: DataFrame, channels: Sequence[int],
                  extra: Sequence[str] = ()) -> DataFrame:
    """(image, label, channel pair, v1, v2, n): distinct value pairs with their counts.

    The channels of a pixel are put side by side in one aggregation instead of a self-join,
    then each pixel gives one row per channel pair. Counting equal pairs before any later
    shuffle folds the repeats of a large flat object.
    """
    return count_pairs(wide_channels(pixels, channels, extra).join(labels, [*IMG, "y", "x"]), channels, extra)


def wide_channels(pixels: DataFrame, channels: Sequence[int], extra: Sequence[str] = ()) -> DataFrame:
    """One row per pixel with a column per channel."""
    return pixels.where(F.col("channel").isin(*channels)).groupBy(*extra, *IMG, "y", "x").agg(*[
        F.max(F.when(F.col("channel") == c, F.col("value"))).alias(f"c{c}") for c in channels])


def count_pairs(wide: DataFrame, channels: Sequence[int], extra: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(i).alias("channel_1"), F.lit(j).alias("channel_2"),
                               F.col(f"c{i}").alias("v1"), F.col(f"c{j}").alias("v2"))
                      for a, i in enumerate(channels) for j in channels[a + 1:]])
    return (wide.select(*extra, *IL, F.inline(pairs)).where("v1 is not null and v2 is not null")
            .groupBy(*extra, *G, "v1", "v2").agg(F.count(F.lit(1)).alias("n")))


def _weighted_pearson(a: Column, b: Column, n: Column) -> Column:
    """Pearson coefficient of counted pairs; NULL for a constant side."""
    total = F.sum(n)
    sa, sb = F.sum(a * n), F.sum(b * n)
    va = total * F.sum(a * a * n) - sa * sa
    vb = total * F.sum(b * b * n) - sb * sb
    cov = total * F.sum(a * b * n) - sa * sb
    return F.when((va > 0) & (vb > 0), F.try_divide(cov, F.sqrt(va) * F.sqrt(vb)))


def _with_means(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values shifted by their group mean: keeps the sums of large values exact enough."""
    means = pairs.groupBy(*keys).agg((F.sum(F.col("v1") * F.col("n")) / F.sum("n")).alias("_m1"),
                                     (F.sum(F.col("v2") * F.col("n")) / F.sum("n")).alias("_m2"))
    return pairs.join(means, list(keys)).withColumns(
        {"v1": F.col("v1") - F.col("_m1"), "v2": F.col("v2") - F.col("_m2")}).drop("_m1", "_m2")


def pearson(pairs: DataFrame, keys: Sequence[str] = tuple(G), center: bool = True) -> DataFrame:
    rows = _with_means(pairs, keys) if center else pairs
    return rows.groupBy(*keys).agg(_weighted_pearson(F.col("v1"), F.col("v2"), F.col("n")).alias("coeff"),
                                   F.sum("n").alias("n"))


def spearman(pairs: DataFrame, keys: Sequence[str] = tuple(G)) -> DataFrame:
    """Pearson coefficient of mid-ranks, shifted by their mean."""
    ranked = pairs
    for side in ("v1", "v2"):
        mid = F.col("below") + (F.col("n") + 1) / 2 - (F.col("below_total") + 1) / 2
        ranks = value_ranks(pairs, keys, side, weight="n").select(*keys, side, mid.alias(f"r{side}"))
        ranked = ranked.join(ranks, [*keys, side])
    ranked = ranked.select(*keys, F.col("rv1").alias("v1"), F.col("rv2").alias("v2"), "n")
    return pearson(ranked, keys, center=False)


def _dense(pairs: DataFrame, keys: Sequence[str], side: str, out: str) -> DataFrame:
    """Attach the 0-based position of each value among the distinct values of its group.

    ``{out}_total`` is the number of distinct values.
    """
    distinct = pairs.select(*keys, side).distinct()
    pos = value_ranks(distinct, keys, side).select(
        *keys, side, F.col("below").alias(out), F.col("below_total").alias(f"{out}_total"))
    return pairs.join(pos, [*keys, side])


def kendall(pairs: DataFrame, keys: Sequence[str] = tuple(G)) -> DataFrame:
    """Kendall tau-b per group, exact, without forming pairs of pixels.

    For two ranks a < b there is one binary digit where b has 1, a has 0 and all higher digits
    agree. So for each digit of the second value's rank, rows are grouped by the higher digits,
    and every row with digit 1 needs the number of rows with digit 0 whose first value is
    smaller: a running count. Each digit gives one row per distinct pair, and running counts
    are cut into value buckets, so no task sorts a whole group.
    """
    keys = list(keys)
    d = _dense(pairs, keys, "v2", "_b").withColumn("_bucket", F.coalesce(order_code(F.col("v1"), RANK_STEPS), F.lit(0).cast("bigint")))
    digits = F.explode(F.sequence(F.lit(0), F.ceil(F.log2("_b_total")).cast("int") - 1)).alias("_digit")
    rows = (d.where("_b_total > 1").select(*keys, "v1", "_bucket", "_b", "n", digits)
            .withColumns({"_high": F.expr("shiftright(_b, _digit + 1)"),
                          "_one": F.expr("shiftright(_b, _digit) & 1")}))
    cell = [*keys, "_digit", "_high"]
    zero = F.when(F.col("_one") == 0, F.col("n")).otherwise(0)
    one = F.when(F.col("_one") == 1, F.col("n")).otherwise(0)
    per = rows.groupBy(*cell, "_bucket", "v1").agg(F.sum(zero).alias("_z"), F.sum(one).alias("_o"))
    run = running_sum(per, cell, ["v1"], F.col("_z"), "_bucket", "_less")
    # Of the zeros of a cell: a smaller first value is concordant, a larger one discordant.
    more = F.col("_less_total") - F.col("_less") - F.col("_z")
    order = run.groupBy(*keys).agg(F.sum(F.col("_o") * F.col("_less")).alias("_con"),
                                   F.sum(F.col("_o") * more).alias("_dis"))

    def tied(side: str, out: str) -> DataFrame:
        per_value = pairs.groupBy(*keys, side).agg(F.sum("n").alias("_t"))
        return per_value.groupBy(*keys).agg(F.sum(F.col("_t") * (F.col("_t") - 1) / 2).alias(out),
                                            F.sum("_t").alias("n"))

    out = tied("v1", "_t1").join(tied("v2", "_t2").drop("n"), keys).join(order, keys, "left")
    all_pairs = F.col("n") * (F.col("n") - 1) / 2
    s = F.coalesce(F.col("_con") - F.col("_dis"), F.lit(0))
    scale = F.sqrt(all_pairs - F.col("_t1")) * F.sqrt(all_pairs - F.col("_t2"))
    return out.select(*keys, F.try_divide(s, F.nullif(scale, F.lit(0.0))).alias("coeff"), "n")


METHODS = {"pearson": pearson, "spearman": spearman, "kendall": kendall}


def _runs(group: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by group and value, first place of each run of equal values of a group); NaN is highest and equals itself."""
    order = np.lexsort((v, group))
    g, w = group[order], v[order]
    new = (g[1:] != g[:-1]) | ((w[1:] != w[:-1]) & ~(np.isnan(w[1:]) & np.isnan(w[:-1])))
    return order, np.flatnonzero(np.concatenate([[True], new]))


def _mid_ranks(group: np.ndarray, first: np.ndarray, size: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Mid-ranks shifted by their mean; ``group`` is sorted, group k begins at first[k] and has size[k] rows."""
    order, run = _runs(group, v)
    n = np.diff(np.append(run, len(v)))
    g = group[order[run]]
    mid = run - first[g] + (n + 1) / 2 - (size[g] + 1) / 2
    out = np.empty(len(v))
    out[order] = np.repeat(mid, n)
    return out


def group_spearman(group: np.ndarray, first: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Spearman's coefficient of each group of rows, NaN for a constant side."""
    a, b = (_mid_ranks(group, first, size, v) for v in (a, b))
    sa, sb, saa, sbb, sab = (np.add.reduceat(v, first) for v in (a, b, a * a, b * b, a * b))
    va, vb = size * saa - sa * sa, size * sbb - sb * sb
    some = (va > 0) & (vb > 0)
    return np.divide(size * sab - sa * sb, np.sqrt(np.where(some, va, 1)) * np.sqrt(np.where(some, vb, 1)), out=np.full(len(size), np.nan), where=some)


def group_kendall(group: np.ndarray, first: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Kendall's tau-b of each group of rows, digit by digit of the second rank as in ``kendall``; NaN for a constant side."""
    ranks, tied = [], []
    for v in (a, b):
        order, run = _runs(group, v)
        n, g = np.diff(np.append(run, len(v))), group[order[run]]
        start = np.searchsorted(g, np.arange(len(size)))
        rank = np.empty(len(v), np.int64)
        rank[order] = np.repeat(np.arange(len(run)) - start[g], n)
        ranks.append(rank)
        tied.append(np.bincount(g, n * (n - 1.0) / 2, len(size)))
    ra, rb = ranks
    s = np.zeros(len(size))
    for digit in range(int(rb.max()).bit_length()):
        high = rb >> (digit + 1)
        cell = group * (int(high.max()) + 1) + high
        order = np.lexsort((ra, cell))
        c, r, one = cell[order], ra[order], (rb[order] >> digit) & 1
        run = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (r[1:] != r[:-1])]))
        ones, zeros = np.add.reduceat(one, run), np.add.reduceat(1 - one, run)
        c = c[run]
        start = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        rows = np.diff(np.append(start, len(c)))
        upto = np.cumsum(zeros) - zeros
        less = upto - np.repeat(upto[start], rows)
        more = np.repeat(np.add.reduceat(zeros, start), rows) - less - zeros
        s += np.bincount(group[order[run]], ones * (less - more).astype(np.float64), len(size))
    pairs = size * (size - 1.0) / 2
    scale = np.sqrt(pairs - tied[0]) * np.sqrt(pairs - tied[1])
    return np.divide(s, scale, out=np.full(len(size), np.nan), where=scale > 0)


WHOLE = {"spearman": group_spearman, "kendall": group_kendall}


def correlate_whole(wide: DataFrame, channels: Sequence[int], method: str, min_periods: int = 1, extra: Sequence[str] = ()) -> DataFrame:
    """Coefficient per object and channel pair from rows (extra, image, label, c0, c1, ...) that are already dealt by object.

    A task puts the rows of its partition in order of the objects and holds one batch and one unfinished object, so this is for
    objects of bounded size; nothing is exchanged.
    """
    keys, cols = [*extra, *IL], [f"c{c}" for c in channels]
    rows = wide.where("image_id is not null and label is not null").select(*keys, *[F.col(c).cast("double") for c in cols]).sortWithinPartitions(*keys)
    fields = [T.StructField(n, k) for n, k in (("channel_1", T.IntegerType()), ("channel_2", T.IntegerType()), ("coeff", T.DoubleType()), ("n", T.LongType()))]
    schema = T.StructType([*rows.select(*keys).schema.fields, *fields])
    arrow, of = to_arrow_schema(schema), WHOLE[method]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_tiles(batches, keys):
            at = np.searchsorted(starts, np.arange(table.num_rows), "right") - 1
            value = [table.column(c).to_numpy() for c in cols]
            there = [table.column(c).is_valid().to_numpy() for c in cols]
            for i, one in enumerate(channels):
                for j in range(i + 1, len(channels)):
                    both = np.flatnonzero(there[i] & there[j])
                    if not len(both):
                        continue
                    owner, first, group = np.unique(at[both], return_index=True, return_inverse=True)
                    n = np.diff(np.append(first, len(both)))
                    coeff = of(group, first, n, value[i][both], value[j][both])
                    row = pa.array(starts[owner])
                    data = [table.column(k).take(row).combine_chunks().cast(f.type) for k, f in zip(keys, arrow)]
                    data += [pa.array(np.full(len(n), c, np.int32)) for c in (one, channels[j])]
                    data += [pa.array(coeff, mask=np.isnan(coeff) | (n < min_periods)), pa.array(n.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(data, schema=arrow)

    return rows.mapInArrow(run, schema)


def channel_correlation(pixels: DataFrame, labels: DataFrame, channels: Sequence[int],
                        method: str = "spearman", min_periods: int = 1) -> DataFrame:
    """Coefficient per object and channel pair i < j; label 0 counts where it is stored.

    Ranks of objects of at most GROUP_ROWS pixels are formed where their rows meet, in one shuffle by object; those of larger
    ones by counted values, spread over many tasks.
    """
    if method == "pearson":
        return correlate_pairs(channel_pairs(pixels, labels, channels), method, min_periods)
    many = large_groups(labels, IL)
    wide = wide_channels(pixels, channels).join(of_groups(labels, many, False), [*IMG, "y", "x"])
    small = correlate_whole(spread(wide.select(*IL, *[f"c{c}" for c in channels]), *IL), channels, method, min_periods)
    pairs = channel_pairs(of_groups(pixels, many.select(*IMG), True), of_groups(labels, many, True), channels)
    return small.unionByName(correlate_pairs(pairs, method, min_periods))


def correlate_pairs(pairs: DataFrame, method: str, min_periods: int = 1,
                    keys: Sequence[str] = tuple(G)) -> DataFrame:
    if method != "pearson":
        # Ranks read the counted pairs several times; what leads to them runs once, when the result is asked for. Parts that
        # are lost with an executor are made again.
        pairs = pairs.persist(StorageLevel.MEMORY_AND_DISK)
    got = METHODS[method](pairs, keys)
    return got.withColumn("coeff", F.when(F.col("n") >= min_periods, F.col("coeff")))


def wide_correlation(long: DataFrame, channels: Sequence[int], method: str, sep: str = "_") -> DataFrame:
    """One row per object, ``{method}_coeff_{i}_{j}`` columns; objects of any pair are kept."""
    cols = [F.max(F.when((F.col("channel_1") == i) & (F.col("channel_2") == j), F.col("coeff")))
            .alias(f"{method}_coeff{sep}{i}{sep}{j}") for a, i in enumerate(channels) for j in channels[a + 1:]]
    return long.groupBy(*IL).agg(*cols)


def permute_within_label(pixels: DataFrame, labels: DataFrame, channels: Sequence[int], n_permutation: int = 1,
                         seed: int = 42, replace: bool = False) -> DataFrame:
    """Values shuffled inside each label, independently per channel and round.

    Returns (round, image, label, slot, c0, c1, ...): the values that meet in slot ``slot`` of
    a label. Slots are positions in row order; the value of a slot is the one whose random
    rank equals it, or a random one of the label with replacement. Labels of at most GROUP_ROWS
    pixels are put in order where their rows meet; in larger ones ranks are counted per bucket, so they are spread over
    many tasks.
    """
    if replace:
        return _permuted_large(pixels, labels, channels, n_permutation, seed, replace)
    many = large_groups(labels, IL)
    small = _permuted_whole(pixels, of_groups(labels, many, False), channels, n_permutation, seed)
    return small.unionByName(_permuted_large(of_groups(pixels, many.select(*IMG), True), of_groups(labels, many, True), channels, n_permutation, seed, replace))


def _random_key(seed: int) -> Column:
    return F.md5(F.concat_ws("|", "image_id", "y", "x", "channel", "round", F.lit(str(seed))))


def _random_slot(seed: int) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws("|", "image_id", "label", "slot", "channel", "round", F.lit(str(seed)))), 1, 12),
                  16, 10).cast("bigint")


def _by_slot(ranked: DataFrame, channels: Sequence[int]) -> DataFrame:
    return ranked.groupBy("round", *IL, "slot").agg(*[
        F.max(F.when(F.col("channel") == c, F.col("value"))).alias(f"c{c}") for c in channels])


def _permuted_whole(pixels: DataFrame, labels: DataFrame, channels: Sequence[int], n_permutation: int, seed: int) -> DataFrame:
    """Objects of bounded size: the pixels are dealt by object once, all else happens where they are."""
    group = [*IL, "channel"]
    px = labels.where("label is not null").join(pixels.where(F.col("channel").isin(*channels)), [*IMG, "y", "x"]).select(*group, "y", "x", "value")
    px = spread(px, *IL)
    rounds = F.explode(F.sequence(F.lit(0), F.lit(n_permutation - 1))).alias("round")
    px = px.select(rounds, *group, "y", "x", "value").withColumn("_h", _random_key(seed))
    place = Window.partitionBy("round", *group).orderBy("_h", "y", "x")
    return _by_slot(px.withColumn("slot", F.row_number().over(place).cast("bigint")), channels)


def _permuted_large(pixels: DataFrame, labels: DataFrame, channels: Sequence[int], n_permutation: int, seed: int, replace: bool) -> DataFrame:
    px = labels.join(pixels.where(F.col("channel").isin(*channels)), [*IMG, "y", "x"])
    rounds = F.explode(F.sequence(F.lit(0), F.lit(n_permutation - 1))).alias("round")
    group = [*IL, "channel"]
    if not replace:
        size = px.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
        px = with_bounds(px, size, group, tile_of("y", "x")).select(rounds, *group, "y", "x", "value", "_rows").withColumn(
            "_h", _random_key(seed))
        ranked = numbered(px, ["round", *group], ["_h", "y", "x"], random_bucket("_h", F.col("_rows")), "slot")
    else:
        ordered = numbered(px, group, ["y", "x"], F.coalesce("y", F.lit(0)), "slot")
        want = ordered.select(rounds, *group, "slot", "slot_total").withColumn(
            "_src", _random_slot(seed) % F.col("slot_total") + 1)
        source = ordered.select(*group, F.col("slot").alias("_src"), "value")
        ranked = want.join(source, [*group, "_src"])
    return _by_slot(ranked, channels)


def permutation_rounds(pixels: DataFrame, labels: DataFrame, channels: Sequence[int], n_permutation: int,
                       method: str = "spearman", seed: int = 42, min_periods: int = 1, replace: bool = False) -> DataFrame:
    """(round, image, label, channel pair, coeff, n): the coefficient of every single round."""
    if method == "pearson" or replace:
        shuffled = permute_within_label(pixels, labels, channels, n_permutation, seed, replace)
        return correlate_pairs(count_pairs(shuffled, channels, ["round"]), method, min_periods, ["round", *G])
    many = large_groups(labels, IL)
    small = correlate_whole(_permuted_whole(pixels, of_groups(labels, many, False), channels, n_permutation, seed), channels, method, min_periods, ["round"])
    shuffled = _permuted_large(of_groups(pixels, many.select(*IMG), True), of_groups(labels, many, True), channels, n_permutation, seed, False)
    return small.unionByName(correlate_pairs(count_pairs(shuffled, channels, ["round"]), method, min_periods, ["round", *G]))


def permuted_correlation(pixels: DataFrame, labels: DataFrame, channels: Sequence[int], n_permutation: int,
                         method: str = "spearman", seed: int = 42, min_periods: int = 1) -> DataFrame:
    """Observed coefficient with mean and sample deviation over permutation rounds."""
    rounds = permutation_rounds(pixels, labels, channels, n_permutation, method, seed, min_periods)
    spread = rounds.groupBy(*G).agg(F.avg("coeff").alias("permuted_mean"),
                                    F.stddev_samp("coeff").alias("permuted_std"))
    return channel_correlation(pixels, labels, channels, method, min_periods).join(spread, G, "left")
