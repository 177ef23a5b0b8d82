"""Helpers shared by the training-data operators: inputs, shared folders, worker state, batch slicing."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see.

    Below ``spark.checkpoint.dir``; below the warehouse where that is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back; cuts lineage, survives lost executors.

    ``group_bytes`` bounds a row group where rows are large: a reader decodes up to 4,096 rows of one at once.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    small = {"parquet.block.size": group_bytes, "parquet.page.size.row.check.min": 1} if group_bytes else {}
    df.write.options(**small).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """Plans made inside hand rows to Python in batches of about ``limit`` bytes; a batch lies in the JVM and in the worker, twice while it grows."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, limit)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def per_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """One object per Python worker process; the tasks that reuse the worker share it.

    The package travels by value, so its module globals are new in every task; ``sys`` is not. There is one slot: an
    object with another key takes the place of the one before, so a worker never holds two.
    """
    held = sys.__dict__.setdefault("_pixelspark_llm", {})
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each; a single row is never cut."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size.astype(np.int64)) // limit
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(int(a), int(b - a))
    pa.default_memory_pool().release_unused()


def strings(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column as large strings, null as empty, in memory of its own: string kernels misread slices of a cast."""
    got = batch.column(batch.schema.get_field_index(column))
    return pc.fill_null(got.take(pa.array(np.arange(len(got)))).cast(pa.large_string()), "")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0].., starts[1].. with the given lengths, one after another."""
    total = int(lengths.sum())
    first = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else starts, lengths)
    return first + np.arange(total)


def list_array(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
