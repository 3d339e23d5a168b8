"""Scalar functions, profiles and row filters over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.catalog.panel import holes
from barloom.catalog.tables import stored
from barloom.catalog.registry import over, query, rnd, rounded, view
from barloom.functions import scoring, text
from barloom.functions.nulls import finite, ratio
from barloom.operators import profile
from barloom.plans import fundamentals as plan
from barloom.sources import tables

# The ten terms of the score (metric, value where missing, scale, points, falls with the metric, floor of the metric).
_TERMS = (
    ("ROE", 0, 40, 15, False, None),
    ("Gross_Margin", 0, 75, 10, False, None),
    ("Profit_Margin", 0, 35, 10, False, None),
    ("Earnings_Growth", 0, 45, 5, False, None),
    ("Forward_PE", 30, 40, 15, True, None),
    ("Price_to_Book", 5, 15, 10, True, None),
    ("PEG_Ratio", 2, 4, 5, True, None),
    ("Current_Ratio", 1, 4, 10, False, None),
    ("Debt_to_Equity", 1, 3, 10, True, None),
    ("Fifty_Two_Week_Change", 0, 60, 10, False, 0),
)
# Borders and labels, highest first; NULL and exact zero are told apart before.
_SIZES = ((200e9, "Mega Cap"), (10e9, "Large Cap"), (2e9, "Mid Cap"))
_LIQUIDITY = ((1.5, "Healthy"), (1.0, "Adequate"))
_VALUATION = ((25, "Growth/Overvalued"), (15, "Fair"), (0, "Value"))


def _listed(values) -> str:
    return "[" + ", ".join("NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"{v}::DOUBLE" if isinstance(v, (int, float)) else f"'{v}'" for v in values) + "]"


def _first_border(column: str, borders, otherwise: str, strict: bool = False) -> str:
    """The label of the first border that the column reaches (or exceeds), from a list."""
    names = _listed([name for _, name in borders])
    passed = f"list_filter(range(1, {len(borders) + 1}), lambda k: {column} {'>' if strict else '>='} {_listed([b for b, _ in borders])}[k])"
    return f"COALESCE({names}[{passed}[1]], '{otherwise}')"


_POINTS = """list_transform(range(1, 11), lambda k: CASE WHEN falls[k] THEN greatest(0.0, (scale[k] - v[k]) / scale[k] * points[k])
  ELSE least(v[k] / scale[k] * points[k], points[k]) END)"""
view("scored", ("stock_dashboard",), f"""
WITH terms AS (SELECT {', '.join(f'{_listed(x)} AS {n}' for n, x in zip(('missing', 'scale', 'points', 'falls', 'least_value'), list(zip(*_TERMS))[1:]))}),
listed AS (SELECT DISTINCT f.*, {_first_border('Market_Cap', _SIZES, 'Small Cap')} AS Market_Cap_Category,
    CASE WHEN Trailing_PE < 0 THEN 'Negative Earnings' ELSE {_first_border('Trailing_PE', _VALUATION, 'Unknown', strict=True)} END AS Valuation_Category,
    CASE WHEN Current_Ratio IS NULL THEN 'Unknown' ELSE {_first_border('Current_Ratio', _LIQUIDITY, 'High Risk')} END AS Liquidity_Health,
    [{', '.join(f'CAST({t[0]} AS DOUBLE)' for t in _TERMS)}] AS m FROM stock_dashboard f),
valued AS (SELECT *, list_transform(range(1, 11), lambda k: greatest(COALESCE(m[k], missing[k]), COALESCE(least_value[k], COALESCE(m[k], missing[k])))) AS v FROM listed, terms)
SELECT * EXCLUDE (m, v, missing, scale, points, falls, least_value),
  CASE WHEN len(list_filter([1, 2, 3, 5, 8], lambda k: m[k] IS NULL)) = 0 THEN ROUND(least(list_reduce({_POINTS}, lambda a, b: a + b), 100.0), 1) END AS Fundamental_Score
FROM valued""")


def scored(spark, sf):
    return plan.scored(tables.stock_dashboard(spark, sf))


@query("X-01 X-02 X-03 X-04 X-05 X-06 P-18 A-09 U-02", over("scored", body="SELECT * FROM scored"))
def scored_fundamentals(spark, sf):
    return scored(spark, sf)


@query("X-01 X-02 X-03 A-10", over("scored", body="""
SELECT Market_Cap_Category, Valuation_Category, Liquidity_Health, COUNT(*) AS "rows", COUNT(DISTINCT Ticker) AS tickers
FROM scored GROUP BY 1, 2, 3"""))
def category_counts(spark, sf):
    return scored(spark, sf).groupBy("Market_Cap_Category", "Valuation_Category", "Liquidity_Health").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("Ticker").alias("tickers")
    )


@query("X-10 X-07 X-08", """
SELECT effective, CONCAT('Latest Update ', STRFTIME(effective, '%Y-%m-%d')) AS update_key, COUNT(*) AS events FROM (
  SELECT CASE WHEN HOUR(ts) < 7 THEN CAST(ts AS DATE) - 1 ELSE CAST(ts AS DATE) END AS effective FROM events) GROUP BY 1, 2""")
def effective_data_day(spark, sf):
    events = tables.given(spark, sf, "events")
    day, label = text.effective_day(F.col("ts")), text.update_key(F.col("ts"))
    return events.groupBy(day.alias("effective"), label.alias("update_key")).agg(F.count(F.lit(1)).alias("events"))


@query("X-09 S-07 S-08", over("bars", body="""
SELECT Date, CAST(Date - 1 AS DATE) AS day_before, CAST(Date - INTERVAL 2 YEAR AS DATE) AS two_years_before, COUNT(*) AS bars
FROM bars GROUP BY Date"""))
def date_arithmetic(spark, sf):
    days = stored(spark, sf, "bars").groupBy("Date").agg(F.count(F.lit(1)).alias("bars"))
    return days.select("Date", F.date_sub("Date", 1).alias("day_before"), F.add_months("Date", -24).alias("two_years_before"), "bars")


@query("X-16 X-17 X-18 X-21 X-26 P-05", """
SELECT p_partkey AS partkey, REPLACE(p_name, ' ', '<br>') AS broken, REPLACE(p_brand, '#', ' ') AS brand,
  CASE WHEN POSITION(' ' IN p_type) > 0 THEN SUBSTR(p_type, POSITION(' ' IN p_type) + 1) ELSE '' END AS after_space,
  CASE WHEN p_size % 3 = 1 THEN 'Potential' WHEN p_size % 3 = 0 THEN 'Non Potential' END AS "Signal", p_size * 100 AS "size percent",
  CONCAT(p_brand, ', ', p_type) AS listed FROM part""")
def text_functions(spark, sf):
    from barloom.plans.screening import signal

    part = tables.given(spark, sf, "part")
    out = part.select(
        F.col("p_partkey").alias("partkey"),
        F.replace("p_name", F.lit(" "), F.lit("<br>")).alias("broken"),
        F.replace("p_brand", F.lit("#"), F.lit(" ")).alias("brand"),
        text.after_first_space(F.col("p_type")).alias("after_space"),
        signal(F.col("p_size") % 3).alias("Signal"),
        (F.col("p_size") * 100).alias("size_percent"),
        F.array_join(F.array("p_brand", "p_type"), ", ").alias("listed"),
    )
    return out.withColumnRenamed("size_percent", text.spaced_names(out.select("size_percent")).columns[0])


@query("X-19 X-24 X-25", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, json_extract_string(props, '$.missing') AS missing,
  TRY_CAST(event_type AS DOUBLE) AS type_number FROM events""")
def tolerant_casts_and_lookups(spark, sf):
    from pyspark.sql import types as T

    events = tables.given(spark, sf, "events")
    keyed = F.from_json("props", T.MapType(T.StringType(), T.StringType()))
    return events.select("event_id", keyed.alias("m"), "event_type").select(
        "event_id", text.number_or_null(F.try_element_at("m", F.lit("k"))).alias("k"),
        F.try_element_at("m", F.lit("missing")).alias("missing"), text.number_or_null(F.col("event_type")).alias("type_number"),
    )


@query("X-20", """
SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_partkey AS partkey, FORMAT('{:.0f}%', l_discount * 100) AS discount,
  FORMAT('{:.1f}x', l_quantity) AS quantity, FORMAT('{:,}', CAST(l_partkey * 1000 AS BIGINT)) AS key_grouped FROM lineitem""")
def number_formats(spark, sf):
    return tables.given(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), F.col("l_partkey").alias("partkey"),
        text.percent(F.col("l_discount"), 0).alias("discount"), text.multiple(F.col("l_quantity")).alias("quantity"),
        text.grouped(F.col("l_partkey") * 1000).alias("key_grouped"),
    )


@query("P-15 X-13", """
SELECT l_returnflag AS returnflag, COUNT(*) AS "rows", COUNT(r) AS finite_rows, ROUND(AVG(r), 6) + 0.0 AS mean_ratio FROM (
  SELECT l_returnflag, l_tax / NULLIF(l_discount, 0) AS r FROM lineitem) GROUP BY 1""")
def infinities_become_null(spark, sf):
    """Division by zero and infinite values count as missing."""
    items = tables.given(spark, sf, "lineitem")
    raw = F.when(F.col("l_discount") == 0, float("inf")).otherwise(ratio(F.col("l_tax"), F.col("l_discount")))
    return rounded(items.select("l_returnflag", finite(raw).alias("r")).groupBy(F.col("l_returnflag").alias("returnflag")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("r").alias("finite_rows"), F.avg("r").alias("mean_ratio")))


@query("P-01 P-02 P-03 P-04 P-17", over("bars", body="SELECT Date, Ticker, Open, Close, Close - Open AS body FROM bars"))
def column_selection(spark, sf):
    """Existing columns of a wish list, without a prefix and without absent names."""
    frame = stored(spark, sf, "bars").withColumn("temp_mid", (F.col("High") + F.col("Low")) / 2).withColumn("body", F.col("Close") - F.col("Open"))
    frame = frame.drop("not_there", "Volume")
    frame = frame.select(*profile.columns_without_prefix(frame, "temp_"))
    wanted = ["Open", "Close", "body", "absent"]
    keep = [c for c in wanted if c in profile.float_columns(frame)]
    return frame.select("Date", "Ticker", *keep)


@query("P-06 P-07 P-16", over("fundamentals", body="""
SELECT Ticker, Extraction_Date, COALESCE(PEG_Ratio, 0) AS PEG_Ratio, ROE, Market_Cap FROM fundamentals
WHERE ROE IS NOT NULL AND Market_Cap IS NOT NULL"""))
def drop_and_fill_nulls(spark, sf):
    frame = tables.fundamentals(spark, sf).select("Ticker", "Extraction_Date", "PEG_Ratio", "ROE", "Market_Cap")
    return frame.na.drop(subset=["ROE", "Market_Cap"]).na.fill(0, ["PEG_Ratio"])


@query("P-08 P-14 J-03 M-16", over("holes", body="""
SELECT h.Ticker, h.Date, h.v, f.First_Valid_Date FROM holes h
JOIN (SELECT Ticker, MIN(Date) AS First_Valid_Date FROM holes WHERE v IS NOT NULL GROUP BY Ticker) f ON h.Ticker = f.Ticker
WHERE h.Date >= f.First_Valid_Date AND h.v IS NULL"""))
def gaps_after_listing(spark, sf):
    frame = holes(spark, sf).select("Ticker", "Date", "v")
    return profile.gaps_after_listing(frame, value="v")


@query("A-11 O-06", """
SELECT * FROM (SELECT "Columns", v AS Skew_Value, CASE WHEN ABS(v) <= 0.5 THEN 'normal' ELSE 'skewed' END AS Distribution FROM (
  SELECT 'l_quantity' AS "Columns", ROUND(SKEWNESS(l_quantity), 1) + 0.0 AS v FROM lineitem
  UNION ALL SELECT 'l_extendedprice', ROUND(SKEWNESS(l_extendedprice), 1) + 0.0 FROM lineitem
  UNION ALL SELECT 'l_discount', ROUND(SKEWNESS(l_discount), 1) + 0.0 FROM lineitem
  UNION ALL SELECT 'squared', ROUND(SKEWNESS(l_extendedprice * l_extendedprice / 1e9), 1) + 0.0 FROM lineitem))
ORDER BY Skew_Value DESC, "Columns" DESC LIMIT 3""")
def skew_table(spark, sf):
    items = tables.given(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", (F.col("l_extendedprice") * F.col("l_extendedprice") / 1e9).alias("squared"))
    return rounded(profile.skew_table(items, last=3))


_PROFILED = ("l_quantity", "l_discount", "l_tax")


@query("A-14", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(COUNT({c}) AS DOUBLE) AS "count", CAST(COUNT(*) - COUNT({c}) AS DOUBLE) AS missing,
  CAST(COUNT(DISTINCT {c}) AS DOUBLE) AS "distinct", {rnd(f'AVG({c})', 'mean', 3)}, {rnd(f'STDDEV_SAMP({c})', 'std', 3)},
  MIN({c}) AS min, MAX({c}) AS max FROM lineitem""" for c in _PROFILED))
def column_profile_exact(spark, sf):
    out = profile.column_profile(tables.given(spark, sf, "lineitem"), _PROFILED, exact_distinct=True)
    return rounded(out.drop("q25", "median", "q75"), mean=3, std=3)


_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("A-14", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(COUNT({c}) AS DOUBLE) AS "count", CAST(COUNT(*) - COUNT({c}) AS DOUBLE) AS missing,
  CAST(COUNT(DISTINCT {c}) AS DOUBLE) AS "distinct", {rnd(f'AVG({c})', 'mean', 3)}, {rnd(f'STDDEV_SAMP({c})', 'std', 3)},
  {rnd(f'MIN({c})', 'min')}, {rnd(f'MAX({c})', 'max')}, {rnd(f'QUANTILE_CONT({c}, 0.25)', 'q25')},
  {rnd(f'QUANTILE_CONT({c}, 0.5)', 'median')}, {rnd(f'QUANTILE_CONT({c}, 0.75)', 'q75')} FROM lineitem""" for c in _NUMBERS))
def column_profile_all_numbers(spark, sf):
    """Every number column, exact quantiles included."""
    return rounded(profile.column_profile(tables.given(spark, sf, "lineitem"), exact_distinct=True, exact_quantiles=True), mean=3, std=3)


@query("A-14 (sketches)")
def column_profile_approximate(spark, sf):
    return profile.column_profile(tables.given(spark, sf, "lineitem"))


@query("A-05", """
SELECT f AS l_returnflag, (SELECT COUNT(*) FROM lineitem WHERE l_returnflag = f) AS count FROM (VALUES ('A'), ('N'), ('R'), ('Z')) t(f)""")
def value_counts_with_absent_label(spark, sf):
    return profile.value_counts(tables.given(spark, sf, "lineitem"), "l_returnflag", ["A", "N", "R", "Z"])


@query("A-01 A-02 S-03 S-04", over("bars", "market", body="""
SELECT b.Ticker, b.Date, b.Close, CAST(b.Date = (SELECT MAX(Date) FROM market) AS INTEGER) AS is_index_day,
  (SELECT DJIA_Close FROM market WHERE Date = (SELECT MAX(Date) FROM market)) AS index_close
FROM bars b JOIN (SELECT Ticker, MAX(Date) AS d FROM bars GROUP BY Ticker) l ON b.Ticker = l.Ticker AND b.Date = l.d"""))
def latest_bar_and_index(spark, sf):
    from barloom.sources.readers import latest_per_series

    bars = stored(spark, sf, "bars")
    last = stored(spark, sf, "market").agg(F.max(F.struct("Date", "DJIA_Close")).alias("m")).scalar()
    return latest_per_series(bars).select(
        "Ticker", "Date", "Close", (F.col("Date") == last["Date"]).cast("int").alias("is_index_day"),
        last["DJIA_Close"].alias("index_close"),
    )


@query("M-14")
def repeatable_row_sample(spark, sf):
    """500 bars, the same ones on every run."""
    return profile.repeatable_sample(stored(spark, sf, "bars"), 500, 10, "Ticker", "Date")
