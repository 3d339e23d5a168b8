"""Reading stored tables: look-back, history and latest-partition filters.

All filters are plain comparisons on the date column, which Spark pushes into Parquet and JDBC
scans and uses for partition pruning. `as_of` is always a parameter, never today's clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the stored tables.
METRICS = (
    "Market_Cap", "Trailing_PE", "Forward_PE", "Price_to_Book", "PEG_Ratio", "EV_to_EBITDA",
    "ROE", "ROA", "Gross_Margin", "Operating_Margin", "Profit_Margin",
    "Current_Ratio", "Quick_Ratio", "Debt_to_Equity", "Cash_per_Share",
    "Revenue_Growth", "Earnings_Growth", "Beta", "Short_Ratio", "Fifty_Two_Week_Change",
)
BARS_SCHEMA = T.StructType(
    [T.StructField("Date", T.DateType()), T.StructField("Ticker", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("Open", "High", "Low", "Close")]
    + [T.StructField("Volume", T.LongType())]
)
INDEX_SCHEMA = T.StructType([T.StructField("Date", T.DateType()), T.StructField("DJIA_Close", T.DoubleType())])
FUNDAMENTALS_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("Ticker", "Company_Name", "Sector")]
    + [T.StructField("Extraction_Date", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in METRICS]
)
PREDICTIONS_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Ticker", T.StringType()),
        T.StructField("Prediction", T.IntegerType()),
        T.StructField("Probability", T.DoubleType()),
    ]
)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet", **options) -> DataFrame:
    """A stored table with a declared schema (csv and json are never inferred)."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, date: str, first: dt.date, last: dt.date, partitions: int, **options
) -> DataFrame:
    """A database table, read by `partitions` parallel date ranges."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=date, lowerBound=str(first), upperBound=str(last))
        .options(numPartitions=str(partitions), **options)
        .load()
    )


def _as_of(as_of: dt.date | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def since_days(frame: DataFrame, as_of: dt.date | Column, days: int = 1, date: str = "Extraction_Date") -> DataFrame:
    return frame.filter(F.col(date) >= F.date_sub(_as_of(as_of), days))


def since_years(frame: DataFrame, as_of: dt.date | Column, years: int = 2, date: str = "Date") -> DataFrame:
    return frame.filter(F.col(date) >= F.add_months(_as_of(as_of), -12 * years))


def between(frame: DataFrame, first: dt.date, last: dt.date | None = None, date: str = "Date") -> DataFrame:
    kept = frame.filter(F.col(date) >= F.lit(first))
    return kept if last is None else kept.filter(F.col(date) <= F.lit(last))


def latest_day(frame: DataFrame, date: str = "Date") -> DataFrame:
    """Rows of the newest date: a scalar subquery, used for run-time partition pruning."""
    return frame.filter(F.col(date) == frame.agg(F.max(date).alias("d")).scalar())


def latest_per_series(frame: DataFrame, key: str = "Ticker", date: str = "Date") -> DataFrame:
    """Last row of each series: one aggregation with map-side combining, no sort of the series."""
    others = [c for c in frame.columns if c not in (key, date)]
    last = frame.groupBy(key).agg(
        F.max(date).alias(date), F.max_by(F.struct(*others), F.col(date)).alias("_v")
    )
    return last.select(key, date, "_v.*").select(*frame.columns)


def lagging(frame: DataFrame, key: str = "Ticker", date: str = "Date") -> DataFrame:
    """Series whose last row is older than the newest date of the table, with the days behind."""
    newest = frame.agg(F.max(date).alias("d")).scalar()
    last = frame.groupBy(key).agg(F.max(date).alias(date))
    return last.filter(F.col(date) < newest).withColumn("days_behind", F.date_diff(newest, F.col(date)))


def in_universe(frame: DataFrame, universe: DataFrame, key: str = "Ticker") -> DataFrame:
    """Keep the series of a ticker list (a semi join; the planner sizes the list)."""
    return frame.join(universe.select(key).distinct(), key, "left_semi")


def universe(spark: SparkSession, tickers: list[str]) -> DataFrame:
    return spark.createDataFrame([(t,) for t in tickers], "Ticker string")
