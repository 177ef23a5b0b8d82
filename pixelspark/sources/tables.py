"""Reading and writing the relations of a screening study."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelspark.schema import IMG, PIXELS, RUN_PARAMS, conform


def read_fov_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Metadata or layout table with an explicit schema; nothing is inferred."""
    reader = spark.read.schema(schema)
    return reader.csv(path, header=True) if fmt == "csv" else reader.format(fmt).load(path)


def read_pixels(spark: SparkSession, path: str, fov: DataFrame | None = None,
                channels: Sequence[int] | None = None, schema: T.StructType = PIXELS, names: Mapping[str, str] | None = None) -> DataFrame:
    """Pixels of the listed fields of view and channels.

    ``schema`` is that of the file, ``names`` its columns that are called differently there than in the relation.

    The channel filter prunes partitions or row groups; the semi join on ``fov`` lets Spark
    prune further at run time and never multiplies rows.
    """
    px = conform(spark.read.parquet(path), schema) if names else spark.read.schema(schema).parquet(path)
    px = px.withColumnsRenamed(dict(names or {}))
    if channels is not None:
        px = px.where(F.col("channel").isin(*channels))
    if fov is not None:
        px = px.join(fov.select("image_id"), IMG, "left_semi")
    return px if names else conform(px, schema)


def fov_shape(pixels: DataFrame, keys: Sequence[str] = tuple(IMG)) -> DataFrame:
    """Channels, height and width of each image and whether all images agree."""
    shape = pixels.groupBy(*keys).agg((F.max("channel") + 1).alias("channels"),
                                      (F.max("y") + 1).alias("height"),
                                      (F.max("x") + 1).alias("width"))
    distinct = shape.agg(F.countDistinct("channels", "height", "width").alias("d"))
    return shape.withColumn("homogeneous", distinct.select(F.col("d") == 1).scalar())


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    """Metadata or measurements to ``path``."""
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_image_table(df: DataFrame, path: str, metadata: Mapping[str, str] | None = None,
                      order: Sequence[str] = ("image_id", "channel", "y", "x"),
                      mode: str = "overwrite") -> None:
    """Pixels, background or labels, laid out by image so that later reads skip row groups.

    Rows are range-partitioned on the full pixel key: one image holding much of the data is
    spread over many files instead of ending in one.
    """
    order = [c for c in order if c in df.columns]
    df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df = df.withColumns({k: F.lit(v) for k, v in (metadata or {}).items()})
    df.write.mode(mode).parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, path: str | None = None,
                   keys: Sequence[str] = ("image_id", "y", "x"), mode: str = "overwrite") -> None:
    """Table bucketed by pixel, so that joins of labels and pixels on ``keys`` need no shuffle.

    The key is the pixel, not the image: an image holding much of the data spreads evenly.
    """
    writer = df.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def run_params(spark: SparkSession, run_id: str, step: str, params: Mapping[str, object]) -> DataFrame:
    """Name/value rows of one processing step."""
    rows = [(run_id, step, k, None if v is None else str(v)) for k, v in params.items()]
    return spark.createDataFrame(rows, RUN_PARAMS)


def write_run_params(spark: SparkSession, path: str, run_id: str, step: str,
                     params: Mapping[str, object]) -> None:
    run_params(spark, run_id, step, params).coalesce(1).write.mode("append").parquet(path)


def keep_missing_inputs(fov: DataFrame, metrics: DataFrame, on: Sequence[str] = tuple(IMG),
                        skip_missing: bool = False) -> DataFrame:
    """Attach metrics; an unreadable field of view keeps a row of NULLs unless skipped."""
    return fov.join(metrics, list(on), "inner" if skip_missing else "left")


def add_step_columns(fov: DataFrame, constants: Mapping[str, object],
                     per_channel: Mapping[str, Mapping[int, object]] | None = None,
                     separator: str = "-") -> DataFrame:
    """Record the settings of a step on every row: scalars, and one column per channel."""
    new = {k: F.lit(v) for k, v in constants.items()}
    for name, by_channel in (per_channel or {}).items():
        new |= {f"{name}{separator}{ch}": F.lit(v) for ch, v in by_channel.items()}
    return fov.withColumns(new)
