"""The daily run on two consecutive days from an empty folder, and some catalog queries."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from barloom.catalog import IDS, ORACLES, QUERIES
from barloom.learning import model as learning
from barloom.learning import research
from barloom.operators import label
from barloom.operators.features import SERVING_FEATURES, feature_frame
from barloom.operators.panel import Panel
from barloom.plans import daily
from barloom.sources import tables as given


@pytest.fixture(scope="module")
def inputs(spark, sf, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    bars = given.bars(spark, sf)
    bars.write.parquet(f"{root}/bars")
    bars = spark.read.parquet(f"{root}/bars")
    market = given.market(spark, sf, bars)
    rows = feature_frame(bars, market, SERVING_FEATURES, fill_market=True)
    label.training_rows(label.with_target(Panel.of(rows)).result()).write.parquet(f"{root}/train")
    train = spark.read.parquet(f"{root}/train")
    small = {"numTrees": 5, "maxDepth": 3, "featureSubsetStrategy": "log2", "minInstancesPerNode": 5}
    return bars, market, train, learning.fit(train, SERVING_FEATURES, learning.forest(**small))


def test_model_properties(spark, inputs, tmp_path):
    _, _, train, fitted = inputs
    weighted = learning.with_class_weight(train)
    total = weighted.agg(F.sum(learning.WEIGHT).alias("w"), F.count(F.lit(1)).alias("n")).collect()[0]
    assert total["w"] == pytest.approx(total["n"])
    scored = learning.predict(fitted, train)
    span = scored.agg(F.min("Probability").alias("a"), F.max("Probability").alias("b")).collect()[0]
    assert 0 <= span["a"] <= span["b"] <= 1
    learning.save(fitted, str(tmp_path / "m"))
    again = learning.predict(learning.load(str(tmp_path / "m")), train)
    assert scored.exceptAll(again).isEmpty()
    ranked = research.importance(fitted, SERVING_FEATURES, spark)
    assert len(research.top_features(ranked, 7)) == 7


def test_two_days(spark, sf, inputs, tmp_path):
    bars, market, _, fitted = inputs
    store = daily.Store(str(tmp_path / "store"))
    snapshots = given.fundamentals(spark, sf)
    # history first, then two daily deliveries; the second is repeated
    last = [r["Date"] for r in bars.select("Date").distinct().orderBy(F.desc("Date")).limit(2).collect()]
    history = F.col("Date") < last[1]
    daily.sinks.replace_days(bars.filter(history).withColumn("Date", F.col("Date")).filter(F.col("Date") >= "1999-01-01"), store.path(daily.BARS))
    daily.sinks.replace_days(market.filter(history & (F.col("Date") >= "1999-01-01")), store.path(daily.INDEX))
    for as_of, day in ((last[1], dt.date(2024, 1, 3)), (last[0], dt.date(2024, 1, 4)), (last[0], dt.date(2024, 1, 4))):
        # snapshots carry their own calendar; the run date is theirs
        delivered = [f.filter(F.col("Date") == as_of) for f in (bars, market)]
        daily.ingest(store, *delivered, snapshots.filter(F.col("Extraction_Date") == day))
        daily.copy_raw(spark, store, day)
        daily.score_fundamentals(spark, store)
        daily.score_series(spark, store, fitted, as_of, years=10)
    scored = spark.read.parquet(store.path(daily.SCORED))
    assert scored.count() == 2 * snapshots.select("Ticker").distinct().count()
    kept = spark.read.parquet(store.path(daily.BARS))
    assert kept.count() == kept.select("Date", "Ticker").distinct().count()
    assert kept.filter(F.col("Date").isin(last)).count() == bars.filter(F.col("Date").isin(last)).count()
    predictions = spark.read.parquet(store.path(daily.PREDICTIONS))
    assert predictions.count() == predictions.select("Date", "Ticker").distinct().count() > 0


QUICK = ["bars_from_ticks", "scored_fundamentals", "main_frame", "quadrant_summary", "rolling_quantile", "long_series_running_state"]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, sf, name):
    db = duckdb.connect()
    for t in ("region", "nation", "supplier", "lineitem", "events"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cursor = db.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = sorted(map(repr, cursor.fetchall()))
    frame = QUERIES[name](spark, sf)
    assert sorted(frame.columns) == sorted(names)
    assert sorted(repr(tuple(r)) for r in frame.select(*[f"`{n}`" for n in names]).collect()) == want


def test_every_query_names_its_operators():
    assert set(IDS) == set(QUERIES) and set(ORACLES) <= set(QUERIES)
    assert all(IDS.values())
