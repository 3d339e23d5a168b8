"""Index series features and each series' relation to the index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.nulls import flag, ratio, zero_to_null
from barloom.operators.frames import Frames
from barloom.operators.joins import one_per_key
from barloom.operators.panel import Panel

# Frame lengths in rows.
INDEX_RETURN_ROWS = (1, 5, 20)
INDEX_AVERAGES = (50, 200)
INDEX_SPREAD_ROWS = 20
BETA_ROWS = 60
INDEX_KEY, INDEX_FILL = "_index", {"_level": "DJIA_Close"}

INDEX_OUTPUTS = ("mkt_return_1d", "mkt_return_5d", "mkt_return_20d", "mkt_above_sma200", "mkt_vol_20d")
OUTPUTS = INDEX_OUTPUTS + ("beta_60d", "alpha_60d", "rs_vs_mkt_20d")
# Carried forward per series when scoring, not when training.
SERVING_FILL = {c: c for c in ("mkt_above_sma200", "mkt_vol_20d", "mkt_return_1d")}


def index_series(market: DataFrame, close: str = "DJIA_Close") -> DataFrame:
    """The index as a series: repeated dates collapsed, with a key so that its windows are panel windows."""
    return one_per_key(market.select("Date", close), "Date").withColumn(INDEX_KEY, F.lit(close))


def index_features(market: DataFrame, close: str = "DJIA_Close") -> DataFrame:
    """One row per date: the index' own returns, averages, regime and spread (cut into segments when it is not daily)."""
    return index_panel(Panel.of(index_series(market, close), key=INDEX_KEY, fill=INDEX_FILL), close).result().select("Date", *INDEX_OUTPUTS, *[f"mkt_sma{n}" for n in INDEX_AVERAGES])


def index_panel(panel: Panel, close: str = "DJIA_Close") -> Panel:
    """The index features on a panel of `index_series`, built with the fill `INDEX_FILL`."""
    w = Frames(panel)
    panel = w.apply(
        {f"mkt_return_{k}d": w.change("_level", k) for k in INDEX_RETURN_ROWS}
        | {f"mkt_sma{n}": w.mean(close, n) for n in INDEX_AVERAGES}
    )
    w = Frames(panel)
    return w.apply(
        {
            "mkt_above_sma200": flag(F.col(close) > F.col("mkt_sma200")),
            "mkt_vol_20d": w.rolling("stddev_samp", "mkt_return_1d", INDEX_SPREAD_ROWS),
        }
    )


def relative_to_index(w: Frames) -> dict[str, Column]:
    variance = zero_to_null(w.rolling("var_samp", "mkt_return_1d", BETA_ROWS))
    beta = ratio(w.cov("return_1d", "mkt_return_1d", BETA_ROWS), variance)
    return {
        "beta_60d": beta,
        "alpha_60d": F.col("return_1d") - beta * F.col("mkt_return_1d"),
        "rs_vs_mkt_20d": F.col("return_20d") - F.col("mkt_return_20d"),
    }
