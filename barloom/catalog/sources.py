"""Sources: landed payloads, histories, look-backs, universe and incremental reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from barloom.catalog.tables import stored
from barloom.catalog.registry import over, query
from barloom.plans.fundamentals import latest_per_key, scored, since_high_water
from barloom.session import shared_dir
from barloom.sources import history, payload, readers, tables


@query("S-02 X-24 X-25", over("payload", body="""
SELECT Ticker, TRY_CAST(json_extract_string(body, '$.marketCap') AS DOUBLE) AS Market_Cap,
  TRY_CAST(json_extract_string(body, '$.trailingPE') AS DOUBLE) AS Trailing_PE
FROM (SELECT * FROM payload WHERE body LIKE '{%')"""))
def payload_without_errors(spark, sf):
    found = tables.payload(spark, sf).select(F.lit("summary_detail").alias("module"), "Ticker", F.col("body").alias("entry"))
    return payload.fundamentals(found, dt.date(2024, 1, 4)).select("Ticker", "Market_Cap", "Trailing_PE")


#: Tickers that one API call covers.
TICKERS = 25


def responses(spark, sf):
    """The newest snapshot as landed API responses: per range of tickers and module one object keyed by
    ticker, with an error text in place of the summary of some tickers."""
    newest = readers.latest_day(tables.fundamentals(spark, sf), "Extraction_Date")
    number = F.regexp_extract("Ticker", "([0-9]+)", 1).cast("bigint")
    batch = F.floor(number / TICKERS).alias("batch")
    out = None
    for module in payload.MODULES:
        fields = [F.col(c).alias(field) for c, (m, field) in payload.FIELDS.items() if m == module]
        entry = F.to_json(F.struct(*fields))
        if module == "summary_detail":
            entry = F.when(number % 12 == 5, '"Quote not found for symbol"').otherwise(entry)
        pairs = newest.select(batch, F.concat(F.lit('"'), "Ticker", F.lit('":'), entry).alias("pair"))
        # one API call covers the tickers of a batch
        bodies = pairs.groupBy("batch").agg(F.concat(F.lit("{"), F.array_join(F.collect_list("pair"), ","), F.lit("}")).alias("body"))
        one = bodies.select(F.lit(module).alias("module"), "body")
        out = one if out is None else out.unionByName(one)
    return out


@query("S-01 S-02 J-04 X-24", over("fundamentals", body=f"""
SELECT Ticker, Company_Name, Sector, Extraction_Date, {', '.join(readers.METRICS)} FROM fundamentals
WHERE Extraction_Date = DATE '2024-01-04' AND CAST(SUBSTR(Ticker, 2) AS BIGINT) % 12 <> 5"""))
def fundamentals_from_responses(spark, sf):
    return payload.fundamentals(payload.entries(responses(spark, sf)), dt.date(2024, 1, 4))


@query("S-07 X-09", over("fundamentals", body="SELECT * FROM fundamentals WHERE Extraction_Date >= DATE '2024-01-04' - 1"))
def one_day_look_back(spark, sf):
    return readers.since_days(tables.fundamentals(spark, sf), dt.date(2024, 1, 4))


@query("S-08", over("bars", body="SELECT * FROM bars WHERE Date >= DATE '1998-06-15' - INTERVAL 2 YEAR"))
def two_year_history(spark, sf):
    return readers.since_years(stored(spark, sf, "bars"), dt.date(1998, 6, 15))


@query("S-05 P-13", over("market", body="SELECT * FROM market WHERE Date >= DATE '1996-01-01' AND Date <= DATE '1998-12-31'"))
def index_history_range(spark, sf):
    return readers.between(stored(spark, sf, "market"), dt.date(1996, 1, 1), dt.date(1998, 12, 31))


@query("S-09 A-07", over("screening", body="SELECT * FROM screening WHERE Date = (SELECT MAX(Date) FROM screening)"))
def latest_predictions(spark, sf):
    """Written by date and read back, so the newest partition alone is scanned."""
    path = shared_dir(spark, "predictions")
    stored(spark, sf, "screening").write.partitionBy("Date").parquet(path)
    written = readers.read_table(spark, path, readers.PREDICTIONS_SCHEMA)
    return readers.latest_day(written).select("Date", "Ticker", "Prediction", "Probability")


@query("S-10", over("scored", body="SELECT * FROM scored WHERE Extraction_Date >= DATE '2024-01-03'"))
def incremental_scoring(spark, sf):
    """Raw rows from the newest scored day on (that day again), scored."""
    raw = tables.stock_dashboard(spark, sf)
    done = scored(raw.filter(F.col("Extraction_Date") <= dt.date(2024, 1, 3)))
    return scored(since_high_water(raw, done))


@query("S-10", over("scored", body="SELECT * FROM scored"))
def initial_scoring(spark, sf):
    """An empty target scores everything."""
    raw = tables.stock_dashboard(spark, sf)
    return scored(since_high_water(raw, scored(raw.filter(F.lit(False)))))


@query("S-12 P-12", over("bars", body="""
SELECT * FROM bars WHERE Ticker IN (SELECT CONCAT('S', CAST(s_suppkey AS VARCHAR)) FROM supplier WHERE s_acctbal > 0)"""))
def bars_of_universe(spark, sf):
    listed = tables.given(spark, sf, "supplier").filter(F.col("s_acctbal") > 0).select(tables.ticker_of(F.col("s_suppkey")).alias("Ticker"))
    return readers.in_universe(stored(spark, sf, "bars"), listed)


@query("S-03 S-04 P-01 X-07", over("bars", body="""
SELECT b.* FROM bars b JOIN (SELECT Ticker, MAX(Date) AS d FROM bars GROUP BY Ticker) l ON b.Ticker = l.Ticker AND b.Date = l.d"""))
def latest_bars(spark, sf):
    """Raw history columns renamed and cast, last row per series."""
    raw = stored(spark, sf, "bars").select(
        F.col("Date").cast("timestamp").alias("date"), F.col("Ticker").alias("symbol"), *[F.col(c).alias(c.lower()) for c in history.FIELDS]
    )
    bars = history.as_bars(raw)
    return readers.latest_per_series(bars).select("Date", "Ticker", *history.FIELDS)


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "UNLISTED")


@query("S-06 U-01 U-03", """
SELECT CAST(o_orderdate AS DATE) AS Date, c_mktsegment AS Ticker, MIN(o_totalprice) AS Open, MAX(o_totalprice) AS High,
  MIN(o_totalprice) AS Low, MAX(o_totalprice) AS Close, CAST(COUNT(*) AS BIGINT) AS Volume
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def wide_history_to_long(spark, sf):
    """A wide table with one column group per market segment (one of them empty), reshaped."""
    orders = tables.given(spark, sf, "orders").join(
        tables.given(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    price = F.col("o_totalprice")
    def cells(s):
        own = F.when(F.col("c_mktsegment") == s, price)
        return [F.min(own).alias(f"{s}_Open"), F.max(own).alias(f"{s}_High"), F.min(own).alias(f"{s}_Low"),
                F.max(own).alias(f"{s}_Close"), F.count(own).alias(f"{s}_Volume")]
    wide = orders.groupBy(F.to_date("o_orderdate").alias("Date")).agg(*[c for s in _SEGMENTS for c in cells(s)])
    return history.wide_to_long(wide, _SEGMENTS).filter(F.col("Close").isNotNull())


@query("Q-08", over("fundamentals", body="SELECT * FROM fundamentals"))
def latest_load_wins(spark, sf):
    """Repeats of the raw copy resolved by the newest load instead of by DISTINCT."""
    raw = tables.stock_dashboard(spark, sf)
    loaded = raw.withColumn("load", F.col("Extraction_Date"))
    return latest_per_key(loaded, "load", "Ticker", "Extraction_Date").drop("load")


@query("Q-18 A-01 A-07", over("bars", body="""
SELECT Ticker, MAX(Date) AS Date, CAST((SELECT MAX(Date) FROM bars) - MAX(Date) AS INTEGER) AS days_behind FROM bars
GROUP BY Ticker HAVING MAX(Date) < (SELECT MAX(Date) FROM bars)"""))
def lagging_series(spark, sf):
    return readers.lagging(stored(spark, sf, "bars"))
