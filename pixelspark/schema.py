"""Column names and explicit schemas of the long-form relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

IMG = ["image_id"]
IC = ["image_id", "channel"]
IL = ["image_id", "label"]
ILC = ["image_id", "label", "channel"]
YX = ["y", "x"]

PIXELS = T.StructType([
    T.StructField("image_id", T.StringType(), False),
    T.StructField("channel", T.IntegerType(), False),
    T.StructField("y", T.IntegerType(), False),
    T.StructField("x", T.IntegerType(), False),
    T.StructField("value", T.DoubleType(), True),
])

LABELS = T.StructType([
    T.StructField("image_id", T.StringType(), False),
    T.StructField("y", T.IntegerType(), False),
    T.StructField("x", T.IntegerType(), False),
    T.StructField("label", T.IntegerType(), False),
])

BACKGROUND = T.StructType([
    T.StructField("strategy_key", T.StringType(), True),
    T.StructField("channel", T.IntegerType(), False),
    T.StructField("y", T.IntegerType(), False),
    T.StructField("x", T.IntegerType(), False),
    T.StructField("value", T.DoubleType(), True),
])

LAYOUT = T.StructType([
    T.StructField("experiment", T.StringType()),
    T.StructField("well", T.IntegerType()),
    T.StructField("treatment", T.StringType()),
])

RUN_PARAMS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("step", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("value", T.StringType()),
])


def finite(c: Column, inf_value: float | None = None) -> Column:
    """NaN becomes NULL and +-Inf becomes ``inf_value`` (NULL by default)."""
    inf = F.lit(inf_value).cast("double")
    is_inf = F.abs(c) == F.lit(float("inf"))
    return F.when(F.isnan(c), None).when(is_inf, inf).otherwise(c)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` in order, cast to their types, NaN and Inf as NULL."""
    out = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        out.append((finite(c) if isinstance(f.dataType, T.DoubleType) else c).alias(f.name))
    return df.select(*out)
