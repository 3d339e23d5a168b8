"""The engine's input tables, derived by Spark from the given star-schema tables.

* `bars`: one OHLCV bar per (supplier, ship date), built from the line items as ticks.
* `market`: an index level per date, with the 13th of each month missing.
* `fundamentals`, `stock_dashboard`, `screening`, `payload`: snapshots keyed by supplier.

Ticks become bars in one hash aggregation with map-side combining (first and last tick by
`min_by`/`max_by`), so a supplier or a day with a large share of the ticks is reduced before the
shuffle and never sorted in one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_DAYS = [dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 1, 4)]


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(x: Column) -> Column:
    """Round half up to cents in plain double arithmetic."""
    return F.floor(x * 100 + 0.5).cast("double") / 100


def ticker_of(key: Column, prefix: str = "S") -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the order of the ticks is put together inside the aggregation: sorted rows hold plain columns only
    at = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    p, tax, discount = F.col("l_extendedprice") / F.col("l_quantity"), F.col("l_tax"), F.col("l_discount")
    return (
        given(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("Date"), "l_suppkey")
        .agg(
            F.min_by(_cents(p), at).alias("Open"),
            F.max(_cents(p * (1 + tax))).alias("High"),
            F.min(_cents(p * (1 - discount))).alias("Low"),
            F.max_by(_cents(p * (1 + tax - discount)), at).alias("Close"),
            F.sum("l_quantity").cast("bigint").alias("Volume"),
        )
        .select("Date", ticker_of(F.col("l_suppkey")).alias("Ticker"), "Open", "High", "Low", "Close", "Volume")
    )


def market(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """Mean close of all bars of a date, averaged over whole cents."""
    frame = bars(spark, sf_dir) if of is None else of
    total = F.sum(F.floor(F.col("Close") * 100 + 0.5).cast("bigint")).cast("double")
    return (
        frame.filter(F.dayofmonth("Date") != 13)
        .groupBy("Date")
        .agg((F.floor(total / F.count(F.lit(1))).cast("double") / 100).alias("DJIA_Close"))
    )


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three daily snapshots per supplier; moduli decide values and missing entries."""
    k, day = F.col("s_suppkey"), F.col("i")
    # per quarter of the suppliers: account balance to market value
    scale = (
        F.when(k % 4 == 0, 3.0e5).when(k % 4 == 1, 1.0e6).when(k % 4 == 2, 2.0e7).otherwise(5.0e7)
    )

    def wave(factor: int, modulus: int, shift: int = 0, tenth: bool = False, daily: bool = False) -> Column:
        value = ((k * factor + (day if daily else F.lit(0))) % modulus - shift).cast("double")
        return value / 10 if tenth else value

    def unless(modulus: int, rest: int, value: Column) -> Column:
        return F.when(k % modulus != rest, value)

    metrics = {
        "Market_Cap": unless(17, 3, F.floor((F.col("s_acctbal") + 1000) * scale).cast("double")),
        "Trailing_PE": unless(13, 5, wave(37, 60, 10, daily=True)),
        "Forward_PE": unless(19, 7, wave(53, 55, 5, daily=True)),
        "Price_to_Book": unless(23, 1, wave(29, 200, tenth=True)),
        "PEG_Ratio": unless(7, 2, wave(31, 60, tenth=True)),
        "EV_to_EBITDA": wave(17, 300, tenth=True),
        "ROE": unless(29, 4, wave(41, 70, 10)),
        "ROA": wave(19, 40, 5),
        "Gross_Margin": wave(43, 100),
        "Operating_Margin": wave(23, 50, 5),
        "Profit_Margin": wave(47, 60, 10),
        "Current_Ratio": unless(11, 6, wave(59, 50, tenth=True)),
        "Quick_Ratio": wave(13, 40, tenth=True),
        "Debt_to_Equity": wave(61, 60, tenth=True),
        "Cash_per_Share": wave(11, 500, tenth=True),
        "Revenue_Growth": wave(7, 80, 20),
        "Earnings_Growth": unless(31, 8, wave(67, 140, 40)),
        "Beta": wave(5, 25, tenth=True),
        "Short_Ratio": wave(3, 90, tenth=True),
        "Fifty_Two_Week_Change": wave(71, 160, 60),
    }
    days = F.array(*[F.lit(d) for d in SNAPSHOT_DAYS])
    return (
        given(spark, sf_dir, "supplier")
        .join(given(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(given(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("*", F.posexplode(days).alias("i", "day"))
        .select(
            ticker_of(k).alias("Ticker"),
            F.col("s_name").alias("Company_Name"),
            F.col("r_name").alias("Sector"),
            F.col("day").alias("Extraction_Date"),
            *[v.alias(n) for n, v in metrics.items()],
        )
    )


def stock_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw copy: each load re-reads two days and appends, so the older two days are doubled."""
    snapshots = fundamentals(spark, sf_dir)
    return snapshots.filter(F.col("Extraction_Date") <= SNAPSHOT_DAYS[1]).unionByName(
        snapshots.filter(F.col("Extraction_Date") >= SNAPSHOT_DAYS[0])
    )


def screening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for two days; some suppliers lack one, some tickers have nothing else."""
    k = F.col("s_suppkey")
    percent = (k * 73 + F.col("i")) % 100
    days = F.array(*[F.lit(d) for d in SNAPSHOT_DAYS[1:]])
    return (
        given(spark, sf_dir, "supplier")
        .filter(k % 9 != 4)
        .select("s_suppkey", F.posexplode(days).alias("i", "Date"))
        .select(
            "Date",
            F.concat(F.when(k % 25 == 24, "X").otherwise("S"), k.cast("string")).alias("Ticker"),
            F.when(percent >= 50, 1).otherwise(0).alias("Prediction"),
            (percent.cast("double") / 100).alias("Probability"),
        )
    )


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response body per ticker: a JSON object, or an error text."""
    k = F.col("s_suppkey")
    cap = F.concat(F.lit('{"marketCap": '), (k * 1000).cast("string"))
    return given(spark, sf_dir, "supplier").select(
        ticker_of(k).alias("Ticker"),
        F.when(k % 12 == 5, "Quote not found for symbol")
        .when(k % 12 == 7, F.concat(cap, F.lit("}")))
        .otherwise(F.concat(cap, F.lit(', "trailingPE": '), (k % 40).cast("string"), F.lit("}")))
        .alias("body"),
    )
