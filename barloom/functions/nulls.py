"""Null rules shared by every operator.

Missing values are NULL only. Divisions never raise and never give infinity: a zero
denominator gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def zero_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(0).cast("double"))


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def flag(condition: Column) -> Column:
    """1 or 0; an unknown comparison counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def positive_part(x: Column) -> Column:
    """max(x, 0), NULL where x is NULL (`greatest` alone would answer 0)."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))


def negative_part(x: Column) -> Column:
    """max(-x, 0), NULL where x is NULL."""
    return F.when(x.isNotNull(), F.greatest(-x, F.lit(0.0)))


def finite(x: Column) -> Column:
    """Infinity and NaN become NULL."""
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def normalise(frame: DataFrame) -> DataFrame:
    """Apply `finite` to every floating column of a frame (used at ingest)."""
    doubles = {f.name for f in frame.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return frame.select([finite(F.col(c)).alias(c) if c in doubles else F.col(c) for c in frame.columns])
