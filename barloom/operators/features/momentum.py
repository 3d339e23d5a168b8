"""Oscillators: relative strength, stochastics, MACD, rate of change, Williams, CCI."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.nulls import flag, ratio, zero_to_null
from barloom.operators.ewm import ewm_mean, span_alpha
from barloom.operators.frames import Frames
from barloom.operators.panel import Panel

# Frame lengths in rows, smoothing factors, CCI scale.
STRENGTH_ALPHA = 1 / 14
RANGE_ROWS = 14
SMOOTH_ROWS = 3
MACD_SPANS = (12, 26, 9)
ROC_ROWS = (5, 10, 20)
CCI_ROWS = 20
CCI_SCALE = 0.015

OUTPUTS = (
    ("rsi_14", "stoch_k", "stoch_d", "macd", "macd_signal", "macd_hist", "macd_cross_up")
    + tuple(f"roc_{n}" for n in ROC_ROWS)
    + ("williams_r", "cci_20")
)
MEANS = {
    "_mean_gain": ("_gain", STRENGTH_ALPHA),
    "_mean_loss": ("_loss", STRENGTH_ALPHA),
    "_fast": ("Close", span_alpha(MACD_SPANS[0])),
    "_slow": ("Close", span_alpha(MACD_SPANS[1])),
}
USES = {"rsi_14": ("_mean_gain", "_mean_loss")} | {
    n: ("_fast", "_slow") for n in ("macd", "macd_signal", "macd_hist", "macd_cross_up")
}
SIGNAL_OUTPUTS = {"macd_signal", "macd_hist", "macd_cross_up"}


def macd(panel: Panel, signal: bool = True) -> Panel:
    """The signal is a mean of a mean, so it needs a second pass."""
    panel = panel.with_columns({"macd": F.col("_fast") - F.col("_slow")})
    return ewm_mean(panel, {"macd_signal": ("macd", span_alpha(MACD_SPANS[2]))}) if signal else panel


def momentum(w: Frames) -> dict[str, Column]:
    have = set(w.panel.frame.columns)
    close = F.col("Close")
    low, high = w.rolling("min", "Low", RANGE_ROWS), w.rolling("max", "High", RANGE_ROWS)
    reach = zero_to_null(high - low)
    deviation = CCI_SCALE * zero_to_null(w.mad("_typical", CCI_ROWS))
    columns = {
        "stoch_k": 100 * ratio(close - low, reach),
        "williams_r": -100 * ratio(high - close, reach),
        "cci_20": ratio(F.col("_typical") - w.mean("_typical", CCI_ROWS), deviation),
    }
    for n in ROC_ROWS:
        base = w.lag("Close", n)
        columns[f"roc_{n}"] = ratio(close - base, zero_to_null(base))
    if "_mean_gain" in have:
        strength = ratio(F.col("_mean_gain"), zero_to_null(F.col("_mean_loss")))
        columns["rsi_14"] = 100 - ratio(F.lit(100.0), 1 + strength)
    if "macd_signal" in have:
        above = F.col("macd") > F.col("macd_signal")
        was_below = w.lag("macd") <= w.lag("macd_signal")
        columns |= {"macd_hist": F.col("macd") - F.col("macd_signal"), "macd_cross_up": flag(above & was_below)}
    return columns


def smooth(w: Frames) -> dict[str, Column]:
    return {"stoch_d": w.mean("stoch_k", SMOOTH_ROWS)}
