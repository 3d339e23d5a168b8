"""Sinks and the incremental load: tables written, rewritten and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from barloom.catalog.tables import stored
from barloom.catalog.registry import over, query
from barloom.plans import fundamentals
from barloom.session import shared_dir
from barloom.sinks import tables as sinks
from barloom.sources import readers, tables
from barloom.streaming.daily_load import load_landed

BAR_COLUMNS = readers.BARS_SCHEMA.names


@query("K-01 X-08", over("fundamentals", body="""
SELECT * REPLACE (CASE WHEN Extraction_Date = DATE '2024-01-03' THEN Beta + 1 ELSE Beta END AS Beta) FROM fundamentals
WHERE Extraction_Date <> DATE '2024-01-03' OR Sector = 'ASIA'"""))
def replace_snapshot_day(spark, sf):
    """A day delivered again, smaller and with other values, replaces that day only."""
    path = shared_dir(spark, "fundamental_data")
    snapshots = tables.fundamentals(spark, sf)
    sinks.replace_days(snapshots, path, "Extraction_Date")
    again = snapshots.filter((F.col("Extraction_Date") == dt.date(2024, 1, 3)) & (F.col("Sector") == "ASIA"))
    sinks.replace_days(again.withColumn("Beta", F.col("Beta") + 1), path, "Extraction_Date")
    return readers.read_table(spark, path, readers.FUNDAMENTALS_SCHEMA).select(*readers.FUNDAMENTALS_SCHEMA.names)


@query("K-02 K-06", over("screening", body="SELECT * FROM screening"))
def replay_predictions(spark, sf):
    """Writing the same days twice leaves one copy; an empty batch changes nothing."""
    path = shared_dir(spark, "stock_screening")
    rows = stored(spark, sf, "screening")
    for batch in (rows, rows, rows.filter(F.lit(False))):
        sinks.replace_days(batch, path)
    return readers.read_table(spark, path, readers.PREDICTIONS_SCHEMA).select(*readers.PREDICTIONS_SCHEMA.names)


def _months(frame):
    """Stored by month here, so that the whole table makes few partitions."""
    return frame.withColumn("Month", F.trunc("Date", "month"))


@query("K-03 J-06 Q-06", over("bars", body="""
SELECT Date, Ticker, Open, High, Low, CASE WHEN CAST(SUBSTR(Ticker, 2) AS BIGINT) % 10 = 0 AND Date >= DATE '1998-01-01' THEN Close + 1 ELSE Close END AS Close, Volume
FROM bars"""))
def replace_bars_by_key(spark, sf):
    """A late correction for some series keeps the other series of the same days."""
    path = shared_dir(spark, "technical_data")
    bars = _months(stored(spark, sf, "bars"))
    sinks.replace_days(bars, path, "Month")
    late = bars.filter((F.substring("Ticker", 2, 20).cast("bigint") % 10 == 0) & (F.col("Date") >= "1998-01-01"))
    late = late.withColumn("Close", F.col("Close") + 1)
    for _ in range(2):  # a replay changes nothing
        sinks.replace_keys(late, path, keys=("Date", "Ticker"), date="Month")
    return spark.read.parquet(path).select(*BAR_COLUMNS)


@query("K-04 S-07", over("fundamentals", body="""
SELECT Ticker, CAST(Extraction_Date AS TIMESTAMP) AS Extraction_Date, Market_Cap FROM fundamentals WHERE Extraction_Date <= DATE '2024-01-03'
UNION ALL SELECT Ticker, CAST(Extraction_Date AS TIMESTAMP), Market_Cap FROM fundamentals WHERE Extraction_Date >= DATE '2024-01-03'"""))
def append_raw_copies(spark, sf):
    path = shared_dir(spark, "stock_dashboard")
    snapshots = tables.fundamentals(spark, sf)
    for day in (dt.date(2024, 1, 3), dt.date(2024, 1, 4)):
        recent = readers.since_days(snapshots.filter(F.col("Extraction_Date") <= day), day)
        sinks.append_raw(recent, path)
    return spark.read.parquet(path).select("Ticker", "Extraction_Date", "Market_Cap")


@query("T-01 K-02 K-03 Q-14", over("bars", body="""
SELECT Date, Ticker, Open, High, Low, CASE WHEN DAYOFMONTH(Date) = 1 THEN Close + 1 ELSE Close END AS Close, Volume FROM bars"""))
def streamed_daily_load(spark, sf):
    """Landed files loaded incrementally; a later drop with corrections rewrites its keys."""
    root = shared_dir(spark, "landed")
    bars = stored(spark, sf, "bars").select(*BAR_COLUMNS)
    late = bars.filter(F.dayofmonth("Date") == 1).withColumn("Close", F.col("Close") + 1)
    for drop in (bars, late):
        drop.write.mode("append").parquet(f"{root}/files")
        load_landed(
            spark, f"{root}/files", readers.BARS_SCHEMA, f"{root}/table", f"{root}/checkpoint",
            date="Month", prepare=_months,
        ).awaitTermination()
    return spark.read.parquet(f"{root}/table").select(*BAR_COLUMNS)


@query("K-05 S-10", over("scored", body="SELECT * FROM scored"))
def scored_days_overwritten(spark, sf):
    """Scored days replaced in the target: the first days, then twice all from the newest scored day on."""
    path = shared_dir(spark, "transformed_stock_dashboard")
    raw = tables.stock_dashboard(spark, sf)
    sinks.replace_days(fundamentals.scored(raw.filter(F.col("Extraction_Date") <= dt.date(2024, 1, 3))), path, "Extraction_Date")
    for _ in range(2):
        new = fundamentals.since_high_water(raw, spark.read.parquet(path))
        sinks.replace_days(fundamentals.scored(new), path, "Extraction_Date")
    written = spark.read.parquet(path)
    return written.select(*fundamentals.scored(raw.limit(0)).columns)
