"""Forward-looking labels and the date split."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.nulls import flag, normalise, ratio
from barloom.operators.panel import Panel

# Rows looked ahead, rise that counts, first test day.
HORIZON = 5
THRESHOLD = 0.03
SPLIT_DAY = dt.date(2022, 1, 1)
RAW_COLUMNS = ("Open", "High", "Low", "Close", "Volume")


def with_target(panel: Panel, horizon: int = HORIZON, threshold: float = THRESHOLD, tail: str = "zero") -> Panel:
    """1 if the close `horizon` rows ahead is more than `threshold` higher, else 0.

    The last `horizon` rows of a series have no future: `tail="zero"` labels them 0,
    `tail="drop"` removes them.
    """
    if tail not in ("zero", "drop"):
        raise ValueError("tail is 'zero' or 'drop'")
    panel = panel.with_columns({"_ahead": panel.lead("Close", horizon), "_later": panel.lead(F.lit(1), horizon)})
    rise = ratio(F.col("_ahead"), F.col("Close")) - 1
    panel = panel.with_columns({"target": flag(rise > threshold)})
    if tail == "drop":
        panel = panel.with_columns({"target": F.when(F.col("_later").isNotNull(), F.col("target"))})
    return panel.drop("_ahead", "_later")


def training_rows(labelled: DataFrame) -> DataFrame:
    """Infinities to NULL, raw columns dropped, rows with any NULL dropped."""
    return normalise(labelled).drop(*RAW_COLUMNS).na.drop("any")


def split_by_day(
    rows: DataFrame, day: dt.date = SPLIT_DAY, purge: int = 0, date: str = "Date"
) -> tuple[DataFrame, DataFrame]:
    """(before, from) the day. `purge` leaves out the last training days, whose labels look into
    the test period; it counts distinct dates, which are few."""
    train, test = rows.filter(F.col(date) < F.lit(day)), rows.filter(F.col(date) >= F.lit(day))
    if purge:
        newest = train.select(date).distinct().orderBy(F.desc(date)).limit(purge)
        train = train.filter(F.col(date) < newest.agg(F.min(date)).scalar())
    return train, test
