"""Price history: renaming, last rows and the wide-to-long reshape."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Source name -> stored name.
BAR_NAMES = {
    "date": "Date", "symbol": "Ticker", "open": "Open", "high": "High", "low": "Low", "close": "Close",
    "volume": "Volume",
}
FIELDS = ("Open", "High", "Low", "Close", "Volume")


def as_bars(history: DataFrame) -> DataFrame:
    """Project and rename a raw history; timestamps become dates."""
    named = history.select(*[F.col(old).alias(new) for old, new in BAR_NAMES.items()])
    return named.withColumn("Date", F.to_date("Date"))


def column_of(ticker: str, field: str) -> str:
    return f"{ticker}_{field}"


def wide_to_long(wide: DataFrame, tickers: Sequence[str], fields: Sequence[str] = FIELDS) -> DataFrame:
    """One column group per ticker -> one row per (Date, Ticker).

    A map-side explode, no union per ticker. Tickers without a single close are dropped: they
    are found by one small aggregation and removed by a semi join.
    """
    def group(ticker: str) -> Column:
        return F.struct(F.lit(ticker).alias("Ticker"), *[F.col(f"`{column_of(ticker, f)}`").alias(f) for f in fields])

    rows = wide.select("Date", F.inline(F.array(*[group(t) for t in tickers])))
    return drop_empty_series(rows)


def drop_empty_series(rows: DataFrame, key: str = "Ticker", value: str = "Close") -> DataFrame:
    listed = rows.filter(F.col(value).isNotNull()).select(key).distinct()
    return rows.join(listed, key, "left_semi").select(*rows.columns)


def union_of(frames: Sequence[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
