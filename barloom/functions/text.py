"""Presentation and parsing functions of the screening tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(x: Column, digits: int = 1) -> Column:
    """0.254 -> 25.4%"""
    return fixed(x * 100, digits, "%")


def fixed(x: Column, digits: int = 2, suffix: str = "") -> Column:
    shown = F.format_string(f"%.{digits}f{suffix.replace('%', '%%')}", x)
    return F.when(x.isNotNull(), shown)


def grouped(x: Column) -> Column:
    """1234567 -> 1,234,567"""
    return F.format_number(x, 0)


def multiple(x: Column) -> Column:
    return fixed(x, 1, "x")


def after_first_space(x: Column) -> Column:
    return F.regexp_extract(x, " (.*)", 1)


def number_or_null(x: Column) -> Column:
    return x.try_cast("double")


def iso_day(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def spaced_names(frame: DataFrame) -> DataFrame:
    """All column names with `_` shown as a space."""
    return frame.toDF(*[c.replace("_", " ") for c in frame.columns])


def effective_day(ts: Column, refresh_hour: int = 7) -> Column:
    """The day whose data is current at a time: yesterday's until the refresh hour."""
    return F.when(F.hour(ts) < refresh_hour, F.date_sub(F.to_date(ts), 1)).otherwise(F.to_date(ts))


def update_key(ts: Column) -> Column:
    return F.concat(F.lit("Latest Update "), iso_day(effective_day(ts)))
