"""Choosing input files from a catalogue DataFrame with a ``name`` column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelspark.functions.text import token


def file_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Name, time and size of each file below ``path``; contents are never read."""
    return (spark.read.format("binaryFile").load(path)
            .select(F.element_at(F.split("path", "/"), -1).alias("name"),
                    F.col("modificationTime").alias("modified"), F.col("length"), F.col("path")))


def _any_of(name: Column, parts: str | Sequence[str]) -> Column:
    parts = [parts] if isinstance(parts, str) else list(parts)
    return reduce(lambda a, b: a | b, [name.contains(p) for p in parts], F.lit(False))


def list_inputs(files: DataFrame, target: str | Sequence[str] | None = None,
                exclude: str | Sequence[str] | None = None, hidden: str = ".",
                name: str = "name") -> DataFrame:
    """Visible files holding any ``target`` and no ``exclude``."""
    keep = ~F.col(name).startswith(hidden)
    if target is not None:
        keep &= _any_of(F.col(name), target)
    if exclude is not None:
        keep &= ~_any_of(F.col(name), exclude)
    return files.where(keep)


def name_date(name: Column, position: int = 0, separator: str = "_", fmt: str = "yyyyMMdd") -> Column:
    """Date held in one token of the file name; NULL where it does not parse."""
    return F.try_to_date(token(name, separator, position), fmt)


def latest_file(files: DataFrame, date: Column, newest: bool = True, name: str = "name") -> DataFrame:
    """The one name with the extreme date; equal dates resolve to the largest name."""
    files = files.select(F.col(name).alias("_name"), date.alias("_date")).where("_date is not null")
    if newest:
        best = F.max(F.struct("_date", "_name"))
    else:
        oldest = F.struct("_date", F.col("_name"))
        return (files.groupBy("_date").agg(F.max("_name").alias("_name"))
                .agg(F.min(oldest).alias("b")).select(F.col("b._name").alias(name)))
    return files.agg(best.alias("b")).select(F.col("b._name").alias(name))


def latest_files(files: DataFrame, date: Column, newest: bool = True, name: str = "name") -> DataFrame:
    """All names sharing the extreme date; no rows for no files."""
    files = files.select(F.col(name), date.alias("_date"))
    pick = F.max if newest else F.min
    extreme = files.agg(pick("_date").alias("_date"))
    return files.join(extreme, "_date", "left_semi").select(name)
