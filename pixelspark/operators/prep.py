"""Preparing the field-of-view table: plate layout, splits, samples, unions, checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelspark.functions.text import split_text_number, trailing_number
from pixelspark.operators.ranking import random_numbered


def layout_lookup(fov: DataFrame, layout: DataFrame, well: str = "well", experiment: str = "experiment",
                  treatment: str = "treatment", well_number: str = "int_well",
                  drop_well_number: bool = False) -> DataFrame:
    """Treatment of each field of view by experiment and well number; NULL where the layout has none.

    Several layout rows for one well resolve to the smallest treatment. The planner broadcasts
    the layout while its size stays below the session threshold and shuffles beyond it.
    """
    per_well = layout.groupBy(F.col(experiment), F.col(well).cast("int").alias(well_number)) \
        .agg(F.min(treatment).alias(treatment))
    out = (fov.withColumn(well_number, trailing_number(F.col(well)))
           .join(per_well, [experiment, well_number], "left"))
    return out.drop(well_number) if drop_well_number else out


def layout_missing(fov: DataFrame, layout: DataFrame, well: str = "well",
                   experiment: str = "experiment") -> DataFrame:
    """Fields of view without a layout row; empty when the lookup is complete."""
    keyed = fov.withColumn("int_well", trailing_number(F.col(well)))
    known = layout.select(experiment, F.col(well).cast("int").alias("int_well"))
    return keyed.join(known, [experiment, "int_well"], "left_anti")


def layout_conditions(df: DataFrame, column: str, unique: bool = True,
                      number_type: str | None = None) -> DataFrame:
    """Prefix and number of each condition name, optionally the unique ones of both kinds."""
    parts = df.select(split_text_number(F.col(column), number_type).alias("p")).select("p.*")
    if not unique:
        return parts
    kinds = F.array(F.struct(F.lit("prefix").alias("part"), F.col("prefix").alias("text")),
                    F.struct(F.lit("number").alias("part"), F.col("number").cast("string").alias("text")))
    return parts.select(F.inline(kinds)).distinct()


def group_lists(layout: DataFrame, keys: Sequence[str], column: str, out: str,
                separator: str = ",") -> DataFrame:
    """Distinct values per group as one sorted text; bounded by the conditions of a well."""
    return (layout.select(*keys, column).distinct().groupBy(*keys)
            .agg(F.array_join(F.sort_array(F.collect_list(column)), separator).alias(out)))


def match_names(files: DataFrame, conditions: DataFrame, name: str = "name",
                condition: str = "condition") -> DataFrame:
    """(condition, name) wherever the condition is part of the file name; an empty one is part of every name.

    A name is cut into its substrings of the lengths that conditions have, so the match is an
    equality join and no name meets every condition. A file name holds at most 255 characters,
    which bounds both the lengths and the substrings. Names are made distinct before they are cut, and equal substrings of a
    name are dropped inside its row, so no substring is put into a table of all substrings.
    """
    lengths = conditions.agg(F.sort_array(F.collect_set(F.length(condition)))).scalar()
    per_length = F.explode(lengths)
    places = F.sequence(F.lit(1), F.length(name) - F.col("_len") + 1)
    cut = (files.select(name).distinct().select(name, per_length.alias("_len")).where("_len between 0 and length(%s)" % name)
           .select(name, F.explode(F.array_distinct(F.transform(places, lambda at: F.col(name).substr(at, F.col("_len"))))).alias(condition)))
    return conditions.select(condition).join(cut, condition)


def match_report(files: DataFrame, conditions: DataFrame, expected: int = 1, name: str = "name",
                 condition: str = "condition") -> DataFrame:
    """Number of files per condition and whether it is the expected one."""
    found = match_names(files, conditions, name, condition).groupBy(condition).agg(F.count(name).alias("n_files"))
    return (conditions.select(condition).distinct().join(found, condition, "left").fillna(0, ["n_files"])
            .withColumn("ok", F.col("n_files") == expected))


def train_test_split(df: DataFrame, key: Sequence[str], test_size: float = 0.3, seed: int = 42,
                     column: str = "is_train", train_value: int = 1, test_value: int = 0) -> DataFrame:
    """Mark an exact share of the rows as test in a reproducible random order.

    The number of test rows is ceil(n * test_size). Rows are kept and no column but the mark
    is added.
    """
    if column in df.columns:
        raise ValueError(f"column {column} already exists")
    rows = random_numbered(df, key, seed, "_rn")
    is_test = F.col("_rn") <= F.ceil(F.round(F.col("_rn_total") * F.lit(float(test_size)), 9))
    return rows.select(*df.columns, F.when(is_test, test_value).otherwise(train_value).alias(column))


def sample_rows(df: DataFrame, key: Sequence[str], fraction: float = 0.5, seed: int = 42) -> DataFrame:
    """Exactly floor(n * fraction + 1/2) rows in a reproducible random order."""
    rows = random_numbered(df, key, seed, "_rn")
    return rows.where(F.col("_rn") <= F.floor(F.col("_rn_total") * F.lit(float(fraction)) + 0.5)).select(*df.columns)


def where_train(df: DataFrame, value: int = 1, column: str = "is_train") -> DataFrame:
    """Rows of the train (or test) set."""
    return df.where(F.col(column) == value)


def require_rows(df: DataFrame, message: str = "no rows are left") -> DataFrame:
    """The same relation; raises when it is empty (reads at most one row)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def union_frames(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Rows of all frames; columns missing in one are NULL."""
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def keys_differ(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present on one side only, with multiplicity; empty for equal key sets."""
    a, b = a.select(*keys), b.select(*keys)
    return (a.exceptAll(b).withColumn("side", F.lit("left"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("right"))))


def keep_in_both(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys present on both sides."""
    return a.select(*keys).intersect(b.select(*keys))


def top_rows(df: DataFrame, order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """First ``n`` rows of an order (a top-k report)."""
    return df.orderBy(*order).limit(n)


def order_columns(df: DataFrame, groups: Sequence[str] = ("label", "overlap", "area", "centroid")) -> DataFrame:
    """Columns grouped by name prefix in the given order; others keep their place in front."""
    def rank(c: str) -> int:
        return next((i for i, g in enumerate(groups) if c.startswith(g)), -1)
    return df.select(*sorted(df.columns, key=rank))
