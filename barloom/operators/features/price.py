"""Candle shape and overnight gap, all relative to the day's open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.nulls import ratio, zero_to_null
from barloom.operators.frames import Frames

OUTPUTS = (
    "return_1d", "return_3d", "return_5d", "return_10d", "return_20d", "overnight_gap",
    "body_size", "upper_shadow", "lower_shadow", "hl_range", "close_position",
)


def price(w: Frames) -> dict[str, Column]:
    opening, close = F.col("Open"), F.col("Close")
    return {
        "overnight_gap": ratio(opening - F.col("_prev_close"), F.col("_prev_close")),
        "body_size": ratio(F.abs(close - opening), opening),
        "upper_shadow": ratio(F.col("High") - F.greatest(close, opening), opening),
        "lower_shadow": ratio(F.least(close, opening) - F.col("Low"), opening),
        "hl_range": ratio(F.col("_spread"), opening),
        "close_position": ratio(close - F.col("Low"), zero_to_null(F.col("_spread"))),
    }
