"""Time helpers that keep the type of the time column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def truncated(df: DataFrame, column: str, unit: str) -> Column:
    """The time cut to the unit, in the column's own type."""
    return F.date_trunc(unit, F.col(column)).cast(df.schema[column].dataType)


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def watermarked(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Declare the event time of a stream. Watermarks need a zoned time, so other times are cast;
    callers cast results back to the type the column had."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)
