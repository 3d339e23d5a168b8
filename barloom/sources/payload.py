"""Landed API responses: JSON objects keyed by ticker, turned into flat snapshots.

Five response modules are joined per ticker. Responses are landed as rows (module, body), one
row per API call, so a module may arrive in any number of batches. A ticker whose entry is an
error text instead of an object is dropped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Module and field of each output column.
FIELDS: dict[str, tuple[str, str]] = {
    "Company_Name": ("price", "shortName"),
    "Sector": ("summary_profile", "sector"),
    "Market_Cap": ("summary_detail", "marketCap"),
    "Trailing_PE": ("summary_detail", "trailingPE"),
    "Forward_PE": ("summary_detail", "forwardPE"),
    "Price_to_Book": ("summary_detail", "priceToBook"),
    "PEG_Ratio": ("key_stats", "pegRatio"),
    "EV_to_EBITDA": ("key_stats", "enterpriseToEbitda"),
    "ROE": ("financial_data", "returnOnEquity"),
    "ROA": ("financial_data", "returnOnAssets"),
    "Gross_Margin": ("financial_data", "grossMargins"),
    "Operating_Margin": ("financial_data", "operatingMargins"),
    "Profit_Margin": ("financial_data", "profitMargins"),
    "Current_Ratio": ("financial_data", "currentRatio"),
    "Quick_Ratio": ("financial_data", "quickRatio"),
    "Debt_to_Equity": ("financial_data", "debtToEquity"),
    "Cash_per_Share": ("financial_data", "totalCashPerShare"),
    "Revenue_Growth": ("financial_data", "revenueGrowth"),
    "Earnings_Growth": ("financial_data", "earningsGrowth"),
    "Beta": ("summary_detail", "beta"),
    "Short_Ratio": ("key_stats", "shortRatio"),
    "Fifty_Two_Week_Change": ("summary_detail", "fiftyTwoWeekChange"),
}
TEXT_COLUMNS = {"Company_Name", "Sector"}
MODULES = ("summary_detail", "key_stats", "financial_data", "price", "summary_profile")


def entries(responses: DataFrame, body: str = "body") -> DataFrame:
    """(module, body keyed by ticker) -> (module, Ticker, entry)."""
    keyed = F.from_json(F.col(body), T.MapType(T.StringType(), T.StringType()))
    others = [c for c in responses.columns if c != body]
    return responses.select(*others, F.explode(keyed).alias("Ticker", "entry"))


def is_object(entry: Column) -> Column:
    return F.coalesce(entry.startswith("{"), F.lit(False))


def _schema(module: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(field, T.StringType() if c in TEXT_COLUMNS else T.DoubleType())
            for c, (m, field) in FIELDS.items()
            if m == module
        ]
    )


def fundamentals(found: DataFrame, as_of: dt.date | Column, universe: DataFrame | None = None) -> DataFrame:
    """(module, Ticker, entry) -> one row per ticker, without tickers that have an error entry.

    The five lookups are one aggregation on the ticker (each module contributes one entry), so
    there is one shuffle instead of four joins. Missing modules and keys give NULL; with a
    `universe`, tickers absent from every response still get a row.
    """
    picked = [F.max(F.when(F.col("module") == m, F.col("entry"))).alias(m) for m in MODULES]
    per_ticker = found.groupBy("Ticker").agg(*picked)
    if universe is not None:
        per_ticker = universe.select("Ticker").distinct().join(per_ticker, "Ticker", "left")
    for m in MODULES:
        per_ticker = per_ticker.filter(F.col(m).isNull() | is_object(F.col(m)))
    parsed = per_ticker.select("Ticker", *[F.from_json(F.col(m), _schema(m)).alias(m) for m in MODULES])
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    values = {c: F.col(m)[field].alias(c) for c, (m, field) in FIELDS.items()}
    names = ["Company_Name", "Sector"]
    return parsed.select(
        "Ticker", *[values[c] for c in names], day.alias("Extraction_Date"),
        *[v for c, v in values.items() if c not in names],
    )
