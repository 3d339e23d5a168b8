"""Long frames put together from short ones; derived tables that are not shuffled again."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.catalog import tables
from barloom.operators.frames import Frames
from barloom.operators.panel import Panel
from barloom.session import SPLIT_BYTES, small_splits


@pytest.fixture(scope="module")
def series(spark):
    pick, first = random.Random(4), dt.date(2020, 1, 1)
    rows = [(k, first + dt.timedelta(days=d), None if k == "B" and d in (70, 300) else pick.uniform(1, 90)) for k in "AB" for d in range(420 if k == "B" else 150)]
    return spark.createDataFrame(rows, "Ticker string, Date date, Close double").repartition(3)


def test_long_sums(series):
    for panel in (Panel.of(series), Panel.of(series.withColumn("Date", F.col("Date").cast("timestamp")), halo=200, rows_per_segment=220)):
        w = Frames(panel)
        out = w.apply({f"mean_{n}": w.mean("Close", n) for n in (5, 50, 60, 200)}).result().withColumn("Date", F.to_date("Date"))
        assert "-199" not in out._jdf.queryExecution().analyzed().toString()  # no frame of 200 rows
        expected = series
        for n in (5, 50, 60, 200):
            frame = Window.partitionBy("Ticker").orderBy("Date").rowsBetween(1 - n, 0)
            expected = expected.withColumn(f"want_{n}", F.when(F.count("Close").over(frame) == n, F.avg("Close").over(frame)))
        both = out.join(expected.drop("Close"), ["Ticker", "Date"]).collect()
        assert len(both) == 570
        for r in both:
            for n in (5, 50, 60, 200):
                assert (r[f"mean_{n}"] is None) == (r[f"want_{n}"] is None)
                assert r[f"mean_{n}"] is None or r[f"mean_{n}"] == pytest.approx(r[f"want_{n}"], rel=1e-12)
        assert any(r["mean_200"] is not None for r in both)


def test_training_tables_are_written_as_their_windows_leave_them(spark, sf, monkeypatch):
    hinted = []
    kind = type(spark.range(1))
    hint = kind.hint
    monkeypatch.setattr(kind, "hint", lambda self, name, *p: (hinted.append((name, *p)), hint(self, name, *p))[1])
    monkeypatch.setattr(tables, "_STORED", {k: v for k, v in tables._STORED.items() if k[2] != "training"})
    tables.stored(spark, sf, "bars")
    hinted.clear()
    assert tables.stored(spark, sf, "training").count() > 0
    assert ("rebalance", "Ticker") not in hinted


def test_bars_are_stored_after_one_shuffle_from_small_splits(spark, sf, monkeypatch):
    seen, name = [], "spark.sql.files.maxPartitionBytes"
    kind = type(spark.range(1))
    hint = kind.hint
    monkeypatch.setattr(kind, "hint", lambda self, name, *p: (seen.append((name, *p)), hint(self, name, *p))[1])
    monkeypatch.setattr(tables, "_STORED", {k: v for k, v in tables._STORED.items() if k[2] != "bars"})
    before = spark.conf.get(name)
    assert tables.stored(spark, sf, "bars").count() == tables.tables.bars(spark, sf).count() and seen == []
    assert spark.conf.get(name) == before
    with small_splits(spark):
        assert int(spark.conf.get(name)) == SPLIT_BYTES
        with small_splits(spark, 100):
            assert int(spark.conf.get(name)) == 100
        with small_splits(spark, 2 * SPLIT_BYTES):
            assert int(spark.conf.get(name)) == SPLIT_BYTES  # a smaller setting stays
    assert spark.conf.get(name) == before


def test_long_covariances(spark):
    pick, first = random.Random(5), dt.date(2020, 1, 1)
    rows = []
    for k in "ABC":
        for d in range(200):
            b = pick.gauss(3, 0.02)
            rows.append((k, first + dt.timedelta(days=d), 1e4 + 2 * b + pick.gauss(0, 0.01), 0.1 if k == "C" else None if k == "B" and d == 90 else b))
    series = spark.createDataFrame(rows, "Ticker string, Date date, a double, b double").repartition(3)
    frame = Window.partitionBy("Ticker").orderBy("Date").rowsBetween(-59, 0)
    whole = F.count("b").over(frame) == 60
    expected = series.select("Ticker", "Date", F.when(whole, F.covar_samp("a", "b").over(frame)).alias("want_c"), F.when(whole, F.var_samp("b").over(frame)).alias("want_v"))
    for panel in (Panel.of(series), Panel.of(series.withColumn("Date", F.col("Date").cast("timestamp")), halo=60, rows_per_segment=70)):
        w = Frames(panel)
        out = w.apply({"c": w.cov("a", "b", 60), "v": w.rolling("var_samp", "b", 60)}).result().withColumn("Date", F.to_date("Date"))
        assert "-59" not in out._jdf.queryExecution().analyzed().toString()  # no frame of 60 rows
        both = out.join(expected, ["Ticker", "Date"]).collect()
        assert len(both) == 600 and sum(r["v"] is not None for r in both) == 141 + 31 + 50 + 141
        for r in both:
            for c, want in ((r["c"], r["want_c"]), (r["v"], r["want_v"])):
                assert (c is None) == (want is None) and (c is None or c == pytest.approx(want, rel=1e-7, abs=1e-13))
            assert r["Ticker"] != "C" or r["v"] in (None, 0.0) and r["c"] in (None, 0.0)  # of equal values exactly none
