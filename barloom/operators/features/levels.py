"""Distance to the support and resistance levels drawn from the previous row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.nulls import ratio, zero_to_null
from barloom.operators.frames import Frames

OUTPUTS = ("dist_pivot", "dist_r1", "dist_s1", "dist_r2", "dist_s2")


def levels(w: Frames) -> dict[str, Column]:
    high, low, last = F.col("_prev_high"), F.col("_prev_low"), F.col("_prev_close")
    close = F.col("Close")
    pivot = (high + low + last) / 3
    level = {"r1": 2 * pivot - low, "s1": 2 * pivot - high, "r2": pivot + (high - low), "s2": pivot - (high - low)}
    # resistance lies above the close, support below it
    gap = {n: (v - close) if n.startswith("r") else (close - v) for n, v in level.items()}
    return {"dist_pivot": ratio(close - pivot, zero_to_null(pivot))} | {
        f"dist_{n}": ratio(g, zero_to_null(close)) for n, g in gap.items()
    }
