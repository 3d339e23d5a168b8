"""Distance to simple and exponential averages, their crossings and slope."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.nulls import flag, ratio
from barloom.operators.ewm import span_alpha
from barloom.operators.frames import Frames

# Lengths of the averages and of the slope, in rows.
AVERAGE_ROWS = (5, 10, 20, 50, 200)
SLOPE_ROWS = 5

OUTPUTS = tuple(f"dist_{kind}_{n}" for n in AVERAGE_ROWS for kind in ("sma", "ema")) + (
    "crossover_ema_5_20", "crossover_sma_50_200", "bullish_regime", "sma20_slope_5d",
)
MEANS = {f"_ema_{n}": ("Close", span_alpha(n)) for n in AVERAGE_ROWS}
USES = {f"dist_ema_{n}": (f"_ema_{n}",) for n in AVERAGE_ROWS} | {"crossover_ema_5_20": ("_ema_5", "_ema_20")}


def trend(w: Frames) -> dict[str, Column]:
    close = F.col("Close")
    sma = {n: w.mean("Close", n) for n in AVERAGE_ROWS}
    ema = {n: F.col(f"_ema_{n}") for n in AVERAGE_ROWS if f"_ema_{n}" in w.panel.frame.columns}
    columns = {f"dist_sma_{n}": ratio(close - v, v) for n, v in sma.items()}
    columns |= {f"dist_ema_{n}": ratio(close - v, v) for n, v in ema.items()}
    if {5, 20} <= set(ema):
        columns["crossover_ema_5_20"] = ratio(ema[5], ema[20])
    return columns | {
        "_sma_20": sma[20],
        "crossover_sma_50_200": ratio(sma[50], sma[200]),
        "bullish_regime": flag(sma[50] > sma[200]),
    }


def slope(w: Frames) -> dict[str, Column]:
    earlier = w.lag("_sma_20", SLOPE_ROWS)
    return {"sma20_slope_5d": ratio(F.col("_sma_20") - earlier, earlier)}
