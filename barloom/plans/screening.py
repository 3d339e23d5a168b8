"""The screening datasets: joined main frame, filters, rankings, aggregates and tables.

Every dataset is lazy and reads the filtered frame; several may share it through `persist`.
Thresholds are parameters whose defaults differ by view on purpose (25, 60 and 70 all mean
"strong" somewhere).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import text
from barloom.sources.readers import latest_day

# Labels, metric groups and column lists of the views.
SIGNALS = {1: "Potential", 0: "Non Potential"}
STRONG_BUY, POTENTIAL, FUNDAMENTAL_STRONG, WATCH_LIST = (
    "🌟 Strong Buy", "⭐ Potential", "💎 Fundamental Strong", "⬜ Watch List",
)
CATEGORIES = (STRONG_BUY, POTENTIAL, FUNDAMENTAL_STRONG, WATCH_LIST)
METRIC_GROUPS = {
    "Profitability": ["ROE", "ROA", "Gross_Margin", "Operating_Margin", "Profit_Margin"],
    "Valuation": ["Trailing_PE", "Forward_PE", "Price_to_Book", "PEG_Ratio", "EV_to_EBITDA"],
    "Liquidity": ["Current_Ratio", "Quick_Ratio", "Debt_to_Equity", "Cash_per_Share"],
    "Growth": ["Revenue_Growth", "Earnings_Growth", "Fifty_Two_Week_Change"],
    "Risk": ["Beta", "Short_Ratio"],
}
COMPARE_METRICS = ["ROE", "Gross_Margin", "Profit_Margin", "Revenue_Growth", "Fundamental_Score"]
STRONG_BUY_COLUMNS = [
    "Ticker", "Company_Name", "Sector", "Fundamental_Score", "Probability", "ROE", "Profit_Margin",
    "Forward_PE", "Valuation_Category",
]
INTEGRATED_COLUMNS = [
    "Ticker", "Company_Name", "Category", "Probability", "Fundamental_Score", "ROE", "Profit_Margin",
    "Forward_PE", "Revenue_Growth", "Debt_to_Equity", "Valuation_Category",
]
ALL_SECTORS = "All"
MIN_PROBABILITY = 0.60
MIN_SCORE = 40


def existing(frame: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in frame.columns]


def by_score(*ties: str) -> list[Column]:
    return [F.col("Fundamental_Score").desc_nulls_last(), *[F.col(t).asc() for t in ties]]


# ---- frames ---------------------------------------------------------------------------


def main_frame(fundamentals: DataFrame, predictions: DataFrame) -> DataFrame:
    """Newest fundamentals and newest predictions, outer joined; no prediction counts as 0."""
    left = latest_day(fundamentals, "Extraction_Date").drop("Extraction_Date")
    return left.join(latest_day(predictions), "Ticker", "full").na.fill(0, ["Prediction", "Probability"])


def filtered(
    main: DataFrame,
    sector: str = ALL_SECTORS,
    min_probability: float = MIN_PROBABILITY,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """A missing score passes, and the probability only binds predicted rows."""
    if sector != ALL_SECTORS:
        main = main.filter(F.col("Sector") == sector)
    score, chance = F.col("Fundamental_Score"), F.col("Probability")
    return main.filter(
        (score.isNull() | (score >= min_score)) & ((F.col("Prediction") == 0) | (chance >= min_probability))
    )


def signal(prediction: Column) -> Column:
    label = F.lit(None).cast("string")
    for value, name in SIGNALS.items():
        label = F.when(prediction == value, name).otherwise(label)
    return label


def category(frame: DataFrame, buy_score: float = 60, strong_score: float = 70) -> DataFrame:
    """Four categories and their chart label; a missing score counts as low."""
    score, predicted = F.col("Fundamental_Score"), F.col("Prediction") == 1
    label = (
        F.when(predicted & (score >= buy_score), STRONG_BUY)
        .when(predicted, POTENTIAL)
        .when(score >= strong_score, FUNDAMENTAL_STRONG)
        .otherwise(WATCH_LIST)
    )
    return frame.withColumn("Category", label).withColumn("Category_Chart", text.after_first_space(F.col("Category")))


# ---- overview ---------------------------------------------------------------------------


def kpis(frame: DataFrame, strong: float = 25, buy: float = 60) -> DataFrame:
    score, predicted = F.col("Fundamental_Score"), F.col("Prediction") == 1
    return frame.agg(
        F.count_if(predicted).alias("potential"),
        F.count_if(score >= strong).alias("strong_fundamental"),
        F.count_if(predicted & (score >= buy)).alias("strong_buy"),
        F.count(F.lit(1)).alias("total"),
    )


def valuation_map(frame: DataFrame) -> DataFrame:
    rows = frame.na.drop(subset=["Forward_PE", "Market_Cap", "ROE", "Fundamental_Score"])
    return rows.select(
        "Ticker", "Company_Name", "Sector", "Forward_PE", "ROE", "Fundamental_Score", "Market_Cap",
        signal(F.col("Prediction")).alias("Signal"),
    )


def top_by_score(frame: DataFrame, n: int = 15) -> DataFrame:
    """The n best, shown from lowest to highest. Ties go to the first ticker, NULL scores last."""
    best = frame.select("Ticker", "Fundamental_Score", "Prediction").orderBy(*by_score("Ticker")).limit(n)
    return best.orderBy(F.col("Fundamental_Score").asc_nulls_last(), "Ticker")


def mean_score_by_sector(frame: DataFrame) -> DataFrame:
    means = frame.filter(F.col("Sector").isNotNull()).groupBy("Sector").agg(F.avg("Fundamental_Score").alias("mean_score"))
    return means.select(F.replace("Sector", F.lit(" "), F.lit("<br>")).alias("Sector"), "mean_score").orderBy(
        F.col("mean_score").desc_nulls_last(), "Sector"
    )


def strong_buys(frame: DataFrame, buy: float = 60) -> DataFrame:
    rows = frame.filter((F.col("Prediction") == 1) & (F.col("Fundamental_Score") >= buy))
    return rows.select(*existing(rows, STRONG_BUY_COLUMNS)).orderBy(*by_score("Ticker"))


# ---- predictions --------------------------------------------------------------------------


def labelled(frame: DataFrame) -> DataFrame:
    return frame.na.drop(subset=["Probability"]).withColumn("Chart_Label", signal(F.col("Prediction")))


def probability_histogram(frame: DataFrame, bins: int = 20) -> DataFrame:
    """Counts per signal in equal bins of [0, 1]; probability 1 belongs to the last bin."""
    slot = F.least(F.floor(F.col("Probability") * bins), F.lit(bins - 1)).cast("int")
    return labelled(frame).groupBy("Chart_Label", slot.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def signal_distribution(frame: DataFrame) -> DataFrame:
    """Both labels always present, 0 where none occurs. One pass, no join."""
    counts = labelled(frame).agg(*[F.count_if(F.col("Chart_Label") == s).alias(s) for s in SIGNALS.values()])
    return counts.unpivot([], list(SIGNALS.values()), "Signal", "count")


def prediction_table(frame: DataFrame) -> DataFrame:
    return labelled(frame).select(
        "Ticker", F.col("Chart_Label").alias("Signal"), (F.col("Probability") * 100).alias("Probability_Percent")
    )


# ---- fundamentals --------------------------------------------------------------------------


def metric_matrix(frame: DataFrame, group: str) -> DataFrame:
    """Long form (Ticker, metric, value) of one metric group."""
    metrics = existing(frame, METRIC_GROUPS[group])
    return frame.select("Ticker", *metrics).unpivot("Ticker", metrics, "metric", "value")


def metric_matrix_wide(frame: DataFrame, group: str, tickers: Sequence[str]) -> DataFrame:
    """Metric x ticker for display of a given list of tickers."""
    rows = metric_matrix(frame.filter(F.col("Ticker").isin(*tickers)), group)
    return rows.groupBy("metric").pivot("Ticker", list(tickers)).agg(F.first("value"))


def compare(frame: DataFrame, tickers: Sequence[str] | None = None, n: int = 4) -> DataFrame:
    """Metrics of chosen tickers (by default the n best) scaled 0-100 over the whole frame.

    The bounds are one aggregate used as a scalar subquery; nothing is cross joined.
    """
    metrics = existing(frame, COMPARE_METRICS)
    bounds = frame.agg(
        F.struct(*[F.struct(F.min(m).alias("lo"), F.max(m).alias("hi")).alias(m) for m in metrics]).alias("b")
    ).scalar()
    if tickers is None:
        rows = frame.orderBy(*by_score("Ticker")).limit(n)
    else:
        if len(tickers) < 2:
            raise ValueError("choose at least two tickers")
        rows = frame.filter(F.col("Ticker").isin(*tickers))
    def scaled(m: str) -> Column:
        lo, hi = bounds[m]["lo"], bounds[m]["hi"]
        return F.round((F.col(m) - lo) / (hi - lo + 1e-9) * 100, 1).alias(m.replace("_", " "))

    wide = rows.select("Ticker", *[scaled(m) for m in metrics])
    return wide.unpivot("Ticker", [m.replace("_", " ") for m in metrics], "metric", "value")


def fundamentals_table(frame: DataFrame) -> DataFrame:
    return text.spaced_names(frame.drop("Prediction", "Probability", "Company_Name", "Sector", "Date"))


def formatted(frame: DataFrame) -> DataFrame:
    """Floating columns as text: two digits, market value with thousands separators."""
    floats = {f.name for f in frame.schema.fields if isinstance(f.dataType, T.DoubleType)}

    def shown(c: str) -> Column:
        if c not in floats:
            return F.col(f"`{c}`")
        return (text.grouped if c == "Market Cap" else text.fixed)(F.col(f"`{c}`")).alias(c)

    return frame.select([shown(c) for c in frame.columns])


# ---- combined -----------------------------------------------------------------------------


def market_cap_scatter(frame: DataFrame) -> DataFrame:
    rows = category(frame).withColumn("Market_Cap", text.number_or_null(F.col("Market_Cap").cast("string")))
    return rows.na.drop(subset=["Market_Cap"]).select(
        "Ticker", "Company_Name", "Sector", "Probability", "Fundamental_Score", "Market_Cap", "ROE",
        "Forward_PE", "Category_Chart",
    )


def quadrants(frame: DataFrame, n: int = 4) -> DataFrame:
    """Count and first n tickers per category; empty categories are kept.

    The n smallest tickers come out of a ranked window that Spark limits per group before the
    shuffle, so a category with most of the rows never gathers in one list.
    """
    rows = category(frame).select("Category", "Ticker")
    counts = rows.groupBy("Category").agg(F.count(F.lit(1)).alias("count"))
    rank = Window.partitionBy("Category").orderBy("Ticker")
    firsts = rows.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= n)
    names = firsts.groupBy("Category").agg(F.array_join(F.array_sort(F.collect_list("Ticker")), ", ").alias("tickers"))
    listed = rows.sparkSession.createDataFrame([(c,) for c in CATEGORIES], "Category string")
    return (
        listed.join(counts, "Category", "left")
        .join(names, "Category", "left")
        .select("Category", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("tickers", F.lit("")).alias("tickers"))
    )


def integrated_table(frame: DataFrame) -> DataFrame:
    rows = category(frame)
    rows = rows.select(*existing(rows, INTEGRATED_COLUMNS)).orderBy(F.col("Category"), *by_score("Ticker"))
    return text.spaced_names(rows)


def growth_vs_profit(frame: DataFrame) -> DataFrame:
    rows = category(frame).na.drop(subset=["Revenue_Growth", "Profit_Margin", "Fundamental_Score"])
    return rows.select(
        "Ticker", "Company_Name", "Revenue_Growth", "Profit_Margin", "Fundamental_Score", "Earnings_Growth", "ROE",
        "Category_Chart",
    )


def sectors(main: DataFrame) -> DataFrame:
    return main.filter(F.col("Sector").isNotNull()).select("Sector").distinct().orderBy("Sector")


def latest_date(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.max("Date").alias("latest_date"))
