"""The screening datasets over newest fundamentals and newest predictions."""

from __future__ import annotations

from barloom.catalog.tables import stored
from barloom.catalog.registry import over, query, rnd, rounded, view
from barloom.plans import screening as plan
from barloom.sources import tables
from barloom.sources.readers import METRICS

_DERIVED = ("Market_Cap_Category", "Valuation_Category", "Liquidity_Health", "Fundamental_Score")
_LEFT = ("Company_Name", "Sector", *METRICS, *_DERIVED)

view("main", ("scored", "screening"), f"""
SELECT COALESCE(f.Ticker, p.Ticker) AS Ticker, {', '.join(f'f.{c}' for c in _LEFT)}, p.Date,
  COALESCE(p.Prediction, 0) AS Prediction, COALESCE(p.Probability, 0) AS Probability
FROM (SELECT * FROM scored WHERE Extraction_Date = (SELECT MAX(Extraction_Date) FROM scored)) f
FULL JOIN (SELECT * FROM screening WHERE Date = (SELECT MAX(Date) FROM screening)) p ON f.Ticker = p.Ticker""")
view("kept", ("main",), """
SELECT * FROM main WHERE (Fundamental_Score >= 40 OR Fundamental_Score IS NULL) AND (Prediction = 0 OR Probability >= 0.6)""")
_CAT = """CASE WHEN Prediction = 1 AND COALESCE(Fundamental_Score >= 60, FALSE) THEN '🌟 Strong Buy' WHEN Prediction = 1 THEN '⭐ Potential'
  WHEN Fundamental_Score >= 70 THEN '💎 Fundamental Strong' ELSE '⬜ Watch List' END"""
view("sorted_in", ("kept",), f"""
SELECT *, {_CAT} AS Category, SUBSTR({_CAT}, POSITION(' ' IN {_CAT}) + 1) AS Category_Chart FROM kept""")
_SIG = "CASE WHEN Prediction = 1 THEN 'Potential' WHEN Prediction = 0 THEN 'Non Potential' END"


def main(spark, sf):
    return plan.main_frame(stored(spark, sf, "scored"), stored(spark, sf, "screening"))


def kept(spark, sf):
    return plan.filtered(main(spark, sf))


@query("D-01 J-02 S-09 A-07 P-16", over("main", body="SELECT * FROM main"))
def main_frame(spark, sf):
    return main(spark, sf)


@query("D-02 P-10", over("kept", body="SELECT * FROM kept"))
def filtered_frame(spark, sf):
    return kept(spark, sf)


@query("D-02 P-09", over("main", body="""
SELECT * FROM main WHERE Sector = 'ASIA' AND (Fundamental_Score >= 25 OR Fundamental_Score IS NULL) AND (Prediction = 0 OR Probability >= 0.8)"""))
def filtered_frame_one_sector(spark, sf):
    return plan.filtered(main(spark, sf), "ASIA", 0.8, 25)


@query("D-03 P-11 A-06", over("kept", body="""
SELECT COUNT(*) FILTER (WHERE Prediction = 1) AS potential, COUNT(*) FILTER (WHERE Fundamental_Score >= 25) AS strong_fundamental,
  COUNT(*) FILTER (WHERE Prediction = 1 AND Fundamental_Score >= 60) AS strong_buy, COUNT(*) AS total FROM kept"""))
def kpi_counts(spark, sf):
    return plan.kpis(kept(spark, sf))


@query("D-04 P-07 X-16", over("kept", body=f"""
SELECT Ticker, Company_Name, Sector, Forward_PE, ROE, Fundamental_Score, Market_Cap, {_SIG} AS "Signal" FROM kept
WHERE Forward_PE IS NOT NULL AND Market_Cap IS NOT NULL AND ROE IS NOT NULL AND Fundamental_Score IS NOT NULL"""))
def valuation_map(spark, sf):
    return plan.valuation_map(kept(spark, sf))


@query("D-05 O-01", over("kept", body="""
SELECT Ticker, Fundamental_Score, Prediction FROM kept ORDER BY Fundamental_Score DESC NULLS LAST, Ticker LIMIT 15"""))
def top_fifteen(spark, sf):
    return plan.top_by_score(kept(spark, sf))


@query("D-06 A-04 X-17 O-04", over("kept", body=f"""
SELECT REPLACE(Sector, ' ', '<br>') AS Sector, {rnd('AVG(Fundamental_Score)', 'mean_score')} FROM kept WHERE Sector IS NOT NULL GROUP BY Sector"""))
def mean_score_by_sector(spark, sf):
    return rounded(plan.mean_score_by_sector(kept(spark, sf)))


@query("D-07 P-04 P-11 O-04", over("main", body=f"""
SELECT {', '.join(plan.STRONG_BUY_COLUMNS)} FROM main WHERE Prediction = 1 AND Fundamental_Score >= 40"""))
def strong_buys(spark, sf):
    return plan.strong_buys(main(spark, sf), buy=40)


@query("D-08 A-12", over("main", body=f"""
SELECT {_SIG} AS Chart_Label, CAST(LEAST(FLOOR(Probability * 20), 19) AS INTEGER) AS bin, COUNT(*) AS count FROM main GROUP BY 1, 2"""))
def probability_histogram(spark, sf):
    return plan.probability_histogram(main(spark, sf))


@query("D-09 A-05", over("kept", body="""
SELECT s AS "Signal", (SELECT COUNT(*) FROM kept WHERE Prediction = p) AS count FROM (VALUES ('Potential', 1), ('Non Potential', 0)) t(s, p)"""))
def signal_distribution(spark, sf):
    return plan.signal_distribution(kept(spark, sf))


@query("D-10 X-21 P-01", over("kept", body=f"""
SELECT Ticker, {_SIG} AS "Signal", {rnd('Probability * 100', 'Probability_Percent')} FROM kept"""))
def prediction_table(spark, sf):
    return rounded(plan.prediction_table(kept(spark, sf)))


_GROUPS = [(g, m) for g, ms in plan.METRIC_GROUPS.items() for m in ms]


@query("D-11 U-04", over("kept", body=" UNION ALL ".join(
    f"SELECT '{g}' AS metric_group, Ticker, '{m}' AS metric, {m} AS value FROM kept" for g, m in _GROUPS)))
def metric_matrix(spark, sf):
    from pyspark.sql import functions as F

    from barloom.sources.history import union_of

    frame = kept(spark, sf)
    return union_of([
        plan.metric_matrix(frame, g).select(F.lit(g).alias("metric_group"), "*") for g in plan.METRIC_GROUPS
    ])


@query("U-04 P-12", over("main", body="""
SELECT m AS metric, MAX(CASE WHEN Ticker = 'S1' THEN v END) AS S1, MAX(CASE WHEN Ticker = 'S2' THEN v END) AS S2, MAX(CASE WHEN Ticker = 'S3' THEN v END) AS S3
FROM (SELECT Ticker, 'Beta' AS m, Beta AS v FROM main UNION ALL SELECT Ticker, 'Short_Ratio', Short_Ratio FROM main)
WHERE Ticker IN ('S1', 'S2', 'S3') GROUP BY m"""))
def metric_matrix_wide(spark, sf):
    return plan.metric_matrix_wide(main(spark, sf), "Risk", ["S1", "S2", "S3"])


def _scaled_sql(source: str, rows: str) -> str:
    return " UNION ALL ".join(
        f"SELECT Ticker, '{m.replace('_', ' ')}' AS metric, ROUND(({m} - (SELECT MIN({m}) FROM {source})) / "
        f"((SELECT MAX({m}) FROM {source}) - (SELECT MIN({m}) FROM {source}) + 1e-9) * 100, 1) + 0.0 AS value FROM ({rows})"
        for m in plan.COMPARE_METRICS)


@query("D-12 O-02 X-23 U-05 A-08", over("kept", body=_scaled_sql(
    "kept", "SELECT * FROM kept ORDER BY Fundamental_Score DESC NULLS LAST, Ticker LIMIT 4")))
def compare_best_four(spark, sf):
    return rounded(plan.compare(kept(spark, sf)))


@query("D-12 P-12 X-23", over("main", body=_scaled_sql("main", "SELECT * FROM main WHERE Ticker IN ('S2', 'S7', 'S10')")))
def compare_chosen(spark, sf):
    return rounded(plan.compare(main(spark, sf), ["S2", "S7", "S10"]))


@query("D-13 P-02 P-05", over("kept", body=f"""
SELECT Ticker, {', '.join(f'{c} AS "{c.replace("_", " ")}"' for c in (*METRICS, *_DERIVED))} FROM kept"""))
def fundamentals_table(spark, sf):
    return plan.fundamentals_table(kept(spark, sf))


@query("D-13 X-20 P-17", over("kept", body="""
SELECT Ticker, FORMAT('{:,}', CAST("Market_Cap" AS BIGINT)) AS "Market Cap", FORMAT('{:.2f}', Beta) AS "Beta" FROM kept"""))
def fundamentals_table_formatted(spark, sf):
    return plan.formatted(plan.fundamentals_table(kept(spark, sf)).select("Ticker", "Market Cap", "Beta"))


def _shown(c: str) -> str:
    kind = {"Market_Cap": "FORMAT('{:,}', CAST(Market_Cap AS BIGINT))"}
    return c if c in _DERIVED[:3] else kind.get(c, f"FORMAT('{{:.2f}}', {c})")


@query("D-13 X-20 P-17", over("kept", body=f"""
SELECT Ticker, {', '.join(f'{_shown(c)} AS "{c.replace("_", " ")}"' for c in (*METRICS, *_DERIVED))} FROM kept"""))
def fundamentals_table_all_formatted(spark, sf):
    """Every number column as it is shown."""
    return plan.formatted(plan.fundamentals_table(kept(spark, sf)))


@query("D-14 X-18 X-19 X-22 P-07 V-04", over("sorted_in", body="""
SELECT Ticker, Company_Name, Sector, Probability, Fundamental_Score, Market_Cap, ROE, Forward_PE, Category_Chart
FROM sorted_in WHERE Market_Cap IS NOT NULL"""))
def market_cap_scatter(spark, sf):
    return plan.market_cap_scatter(kept(spark, sf))


@query("D-15 A-13 X-22 X-26 O-05", over("sorted_in", body="""
SELECT t.c AS Category, COUNT(s.Ticker) AS count, COALESCE(STRING_AGG(CASE WHEN rk <= 4 THEN Ticker END, ', ' ORDER BY Ticker), '') AS tickers
FROM (VALUES ('🌟 Strong Buy'), ('⭐ Potential'), ('💎 Fundamental Strong'), ('⬜ Watch List')) t(c)
LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY Category ORDER BY Ticker) AS rk FROM sorted_in) s ON s.Category = t.c GROUP BY t.c"""))
def quadrant_summary(spark, sf):
    return plan.quadrants(kept(spark, sf))


@query("D-16 O-03 P-05 V-05", over("sorted_in", body=f"""
SELECT {', '.join(f'{c} AS "{c.replace("_", " ")}"' for c in plan.INTEGRATED_COLUMNS)} FROM sorted_in"""))
def integrated_table(spark, sf):
    return plan.integrated_table(kept(spark, sf))


@query("D-17 P-07", over("sorted_in", body="""
SELECT Ticker, Company_Name, Revenue_Growth, Profit_Margin, Fundamental_Score, Earnings_Growth, ROE, Category_Chart
FROM sorted_in WHERE Revenue_Growth IS NOT NULL AND Profit_Margin IS NOT NULL AND Fundamental_Score IS NOT NULL"""))
def growth_vs_profit(spark, sf):
    return plan.growth_vs_profit(kept(spark, sf))


@query("D-18 A-10", over("main", body="SELECT DISTINCT Sector FROM main WHERE Sector IS NOT NULL"))
def sector_list(spark, sf):
    return plan.sectors(main(spark, sf))


@query("D-18 A-07", over("screening", body="SELECT MAX(Date) AS latest_date FROM screening"))
def latest_prediction_date(spark, sf):
    return plan.latest_date(stored(spark, sf, "screening"))
