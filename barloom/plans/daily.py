"""The daily run: ingest, score fundamentals, score series, all for one `as_of` day.

Tables live under one root folder and are partitioned by date. Every step is idempotent, so a
run can be repeated for any day.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.learning import model as learning
from barloom.operators import state as running
from barloom.operators.features import SERVING_FEATURES, feature_frame
from barloom.plans import fundamentals, screening
from barloom.sinks import tables as sinks
from barloom.sources import readers


@dataclass(frozen=True)
class Store:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


# Table names.
BARS, INDEX, SNAPSHOTS, RAW, SCORED, PREDICTIONS = (
    "technical_data", "market_data", "fundamental_data", "stock_dashboard", "transformed_stock_dashboard",
    "stock_screening",
)
STATE = "feature_state"


class Daily(NamedTuple):
    """The joined screening frame, and the last (Date, Ticker) of each series that could not be scored."""

    frame: DataFrame
    left_out: DataFrame


def ingest(store: Store, bars: DataFrame, index: DataFrame, snapshots: DataFrame) -> None:
    """Replace the delivered keys; rows of other series on the same days stay."""
    sinks.replace_keys(bars, store.path(BARS))
    sinks.replace_keys(index, store.path(INDEX), keys=("Date",))
    sinks.replace_days(snapshots, store.path(SNAPSHOTS), "Extraction_Date")


def copy_raw(spark: SparkSession, store: Store, as_of: dt.date, days: int = 1) -> None:
    """Append the last days' snapshots to the raw copy; repeats are expected there."""
    recent = readers.since_days(spark.read.parquet(store.path(SNAPSHOTS)), as_of, days)
    sinks.append_raw(recent.select(*readers.FUNDAMENTALS_SCHEMA.names), store.path(RAW))


def score_fundamentals(spark: SparkSession, store: Store) -> None:
    """Score the raw rows from the target's newest day on and replace those days."""
    raw = spark.read.parquet(store.path(RAW))
    raw = raw.withColumn("Extraction_Date", raw["Extraction_Date"].cast("date"))
    target = store.path(SCORED)
    known = spark.read.parquet(target) if sinks.table_exists(spark, target) else None
    sinks.replace_days(fundamentals.scored(fundamentals.since_high_water(raw, known)), target, "Extraction_Date")


def score_series(spark: SparkSession, store: Store, model: PipelineModel, as_of: dt.date, years: int = 2) -> DataFrame:
    """Features over the look-back, last row per series, prediction, replace by day; the series left out.

    Running features start where the look-back starts: train with the same start. The result holds
    the last (Date, Ticker) of each series that lacks a feature and so could not be scored.
    """
    bars = readers.since_years(spark.read.parquet(store.path(BARS)), as_of, years)
    index = readers.since_years(spark.read.parquet(store.path(INDEX)), as_of, years)
    rows = feature_frame(bars, index, SERVING_FEATURES, fill_market=True)
    sinks.replace_days(learning.score_latest(model, rows, SERVING_FEATURES), store.path(PREDICTIONS))
    return learning.unscorable(rows, SERVING_FEATURES)


def score_resumed(
    spark: SparkSession, store: Store, model: PipelineModel, as_of: dt.date, start: dt.date, late_days: int = 31
) -> DataFrame:
    """Features of the new bars from the stored feature state, prediction, replace by day; the series left out.

    `start` is the first day of the history that the model was trained on (`learning.history_start`); the state must have
    been begun there, else an error is raised. Without a state the history from `start` on begins one. Read are only bars of the
    last `late_days` days, and of these those behind the last known bar of their series. Repeating a day starts from the state of
    the day before it.
    """
    path = store.path(STATE)
    before = running.load_state(spark, path, as_of)
    tables = [spark.read.parquet(store.path(t)).filter(F.col("Date") <= F.lit(as_of)) for t in (BARS, INDEX)]
    if before is None:
        bars, market = (t.filter(F.col("Date") >= F.lit(start)) for t in tables)
    else:
        if before.start != start:
            raise ValueError(f"the model's history starts on {start}, the state's on {before.start}")
        recent = [t.filter(F.col("Date") > F.lit(as_of - dt.timedelta(days=late_days))) for t in tables]
        known = before.series.select("Ticker", F.col("last").alias("_last"))
        bars = recent[0].join(known, "Ticker", "left").filter("_last IS NULL OR Date > _last").drop("_last")
        market = recent[1].filter(F.col("Date") > F.lit(before.market.agg(F.max("last")).first()[0]))
    rows, after = running.advance(bars, market, SERVING_FEATURES, before, fill_market=True, start=start)
    running.save_state(after, path, as_of)
    sinks.replace_days(learning.score_latest(model, rows, SERVING_FEATURES), store.path(PREDICTIONS))
    return learning.unscorable(rows, SERVING_FEATURES)


def run_daily(
    spark: SparkSession, store: Store, as_of: dt.date, bars: DataFrame, index: DataFrame, snapshots: DataFrame,
    model: PipelineModel, years: int = 2, start: dt.date | None = None,
) -> Daily:
    """All steps of one day; the joined screening frame and the series left out.

    With `start` (the first day of the model's history), running features continue from the stored state. Without, they start
    at a look-back of `years`; train the model with the same value.
    """
    ingest(store, bars, index, snapshots)
    copy_raw(spark, store, as_of)
    score_fundamentals(spark, store)
    left_out = score_resumed(spark, store, model, as_of, start) if start else score_series(spark, store, model, as_of, years)
    return Daily(screening.main_frame(spark.read.parquet(store.path(SCORED)), spark.read.parquet(store.path(PREDICTIONS))), left_out)
