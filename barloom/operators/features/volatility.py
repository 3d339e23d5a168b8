"""Spread of returns, average true range, and price bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.nulls import flag, ratio, zero_to_null
from barloom.operators.frames import Frames

# Frame lengths in rows, band width in deviations, squeeze quantile.
SPREAD_ROWS = (5, 10, 20)
RANGE_ALPHA = 1 / 14
BAND_ROWS = 20
BAND_DEVIATIONS = 2
SQUEEZE_QUANTILE = 0.2

OUTPUTS = tuple(f"volatility_{n}d" for n in SPREAD_ROWS) + ("atr_14", "atr_pct", "vol_ratio_5_20")
BAND_OUTPUTS = ("bb_width", "bb_pct", "bb_squeeze")
MEANS = {"atr_14": ("_true_range", RANGE_ALPHA)}
USES = {"atr_14": ("atr_14",), "atr_pct": ("atr_14",)}


def volatility(w: Frames) -> dict[str, Column]:
    spread = {n: w.rolling("stddev_samp", "return_1d", n) for n in SPREAD_ROWS}
    columns = {f"volatility_{n}d": v for n, v in spread.items()}
    columns["vol_ratio_5_20"] = ratio(spread[5], zero_to_null(spread[20]))
    if "atr_14" in w.panel.frame.columns:
        columns["atr_pct"] = ratio(F.col("atr_14"), F.col("Close"))
    return columns


def bands(w: Frames) -> dict[str, Column]:
    middle = w.mean("Close", BAND_ROWS)
    reach = BAND_DEVIATIONS * w.rolling("stddev_samp", "Close", BAND_ROWS)
    width = (middle + reach) - (middle - reach)
    return {
        "bb_width": ratio(width, middle),
        "bb_pct": ratio(F.col("Close") - (middle - reach), zero_to_null(width)),
    }


def squeeze(w: Frames) -> dict[str, Column]:
    return {"bb_squeeze": flag(F.col("bb_width") < w.quantile("bb_width", SQUEEZE_QUANTILE, BAND_ROWS))}
