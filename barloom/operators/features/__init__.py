"""Feature families and the two assembled feature sets.

All families read one panel: one hash exchange on the series key, and window nodes merged by the
optimizer. Exponential means of all families run in one pass.
"""

from __future__ import annotations

from dataclasses import replace
from typing import Iterable

from pyspark.sql import Column, DataFrame

from barloom.operators.ewm import ewm_mean
from barloom.operators.features import index, inputs, levels, momentum, price, trend, volatility, volume
from barloom.operators.frames import Frames
from barloom.operators.joins import join_on_date
from barloom.operators.panel import Panel

# All candidate features, in the order in which they are offered to the learner.
RESEARCH_FEATURES = (
    price.OUTPUTS + trend.OUTPUTS + volatility.OUTPUTS + momentum.OUTPUTS + volume.OUTPUTS
    + volatility.BAND_OUTPUTS + index.OUTPUTS + levels.OUTPUTS
)

# The features of the deployed model, in its column order.
SERVING_FEATURES = (
    "return_5d", "return_20d", "body_size", "upper_shadow", "hl_range", "dist_sma_10",
    "dist_ema_10", "crossover_ema_5_20", "crossover_sma_50_200", "sma20_slope_5d",
    "volatility_5d", "volatility_10d", "volatility_20d", "atr_pct", "rsi_14", "williams_r",
    "cci_20", "vol_ratio", "vol_change_1d", "obv", "vpt", "adl", "cmf_20", "mkt_above_sma200",
    "mkt_vol_20d", "beta_60d", "dist_pivot", "dist_r1", "dist_s1", "dist_r2",
)

_MEANS = trend.MEANS | volatility.MEANS | momentum.MEANS
_USES = trend.USES | volatility.USES | momentum.USES


# Families whose frames need only inputs, then those whose frames need another feature.
_STAGES = (
    (
        (price.OUTPUTS, price.price),
        (trend.OUTPUTS, trend.trend),
        (volatility.OUTPUTS, volatility.volatility),
        (momentum.OUTPUTS, momentum.momentum),
        (volume.OUTPUTS, volume.volume),
        (volatility.BAND_OUTPUTS, volatility.bands),
        (("beta_60d", "alpha_60d", "rs_vs_mkt_20d"), index.relative_to_index),
        (levels.OUTPUTS, levels.levels),
    ),
    (
        (("sma20_slope_5d",), trend.slope),
        (("stoch_d",), momentum.smooth),
        (("bb_squeeze",), volatility.squeeze),
    ),
)


def panel_of_bars(
    bars: DataFrame, market: DataFrame | None = None, fill_market: bool = False, **panel_options
) -> Panel:
    """Bars, optionally with the index features joined on, as a panel ready for `features`.

    `fill_market` carries the index columns forward over dates the index misses: the daily
    scoring job does, training does not.
    """
    fill = dict(inputs.FILL)
    if market is not None:
        bars = join_on_date(bars, index.index_features(market))
        fill |= index.SERVING_FILL if fill_market else {}
    return Panel.of(bars, fill=fill, **panel_options)


def features(panel: Panel, names: Iterable[str]) -> Panel:
    """Add the named features (any of `RESEARCH_FEATURES`)."""
    names = list(names)
    unknown = set(names) - set(RESEARCH_FEATURES)
    if unknown:
        raise ValueError(f"unknown features: {sorted(unknown)}")
    if set(names) & set(index.OUTPUTS) and "mkt_return_1d" not in panel.frame.columns:
        raise ValueError("index features need a panel built with the index series")
    base = [c for c in panel.frame.columns if c not in names]

    panel = inputs.with_inputs(panel)
    means = {m for n in names for m in _USES.get(n, ())}
    if means:
        panel = ewm_mean(panel, {m: _MEANS[m] for m in _MEANS if m in means})
    if {"_fast", "_slow"} <= means:
        panel = momentum.macd(panel, signal=bool(momentum.SIGNAL_OUTPUTS & set(names)))
    if set(volume.RUNNING) & set(names):
        panel = panel.running_sum({n: c for n, c in volume.RUNNING.items() if n in names})
    for stage in _STAGES:
        w = Frames(panel)
        columns: dict[str, Column] = {}
        for outputs, family in stage:
            if set(outputs) & set(names):
                columns |= family(w)
        panel = w.apply(columns)
    out = [f"_out_{n}" for n in panel.leaving if f"_out_{n}" not in base]
    return replace(panel, frame=panel.frame.select(*base, *names, *out))


def feature_frame(bars: DataFrame, market: DataFrame | None, names: Iterable[str], fill_market: bool = False) -> DataFrame:
    """(Date, Ticker, OHLCV, features...) for a table of bars."""
    names = list(names)
    out = features(panel_of_bars(bars, market, fill_market), names).result()
    return out.select("Date", "Ticker", "Open", "High", "Low", "Close", "Volume", *names)
