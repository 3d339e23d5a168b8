"""Panel operators against pandas, on calendar panels and on split panels of the same rows."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators.ewm import ewm_mean, span_alpha
from barloom.operators.frames import Frames
from barloom.operators.panel import Panel

GAPS = [10.0, None, 12.0, 11.0, None, None, 15.0]


def walk(n, seed, holes=0.1, lead=0, gap=0):
    rng = np.random.default_rng(seed)
    v = 100 + np.cumsum(rng.normal(size=n))
    v[rng.random(n) < holes] = np.nan
    v[:lead] = np.nan
    if gap:
        v[n // 2 : n // 2 + gap] = np.nan
    return v


def frame_of(spark, series, minutes=False):
    parts = []
    for key, v in series.items():
        step = pd.Timedelta(minutes=1) if minutes else pd.Timedelta(days=1)
        t = pd.Timestamp("1990-01-01") + step * np.arange(len(v))
        parts.append(pd.DataFrame({"Ticker": key, "Date": t, "v": np.asarray(v, dtype=float)}))
    pdf = pd.concat(parts)
    frame = spark.createDataFrame(pdf.assign(v=pdf.v.astype(object).where(pdf.v.notna(), None)),
                                  "Ticker string, Date timestamp, v double")
    return pdf, frame if minutes else frame.withColumn("Date", F.to_date("Date"))


def panels(spark, series, fill=None, halo=64):
    pdf, daily = frame_of(spark, series)
    yield pdf, Panel.of(daily, fill=fill)
    pdf, minutes = frame_of(spark, series, minutes=True)
    # 1,000 rows a segment, 240-row buckets: every long series is cut many times
    yield pdf, Panel.of(minutes, fill=fill, halo=halo, rows_per_segment=1000, bucket_seconds=14_400)


def collected(panel):
    out = panel.result().toPandas()
    out["Date"] = pd.to_datetime(out["Date"])
    return out.sort_values(["Ticker", "Date"]).reset_index(drop=True)


def same(actual, expected, rel=1e-9):
    a, e = actual.to_numpy(float), expected.to_numpy(float)
    assert (np.isnan(a) == np.isnan(e)).all()
    np.testing.assert_allclose(a, e, rtol=rel, atol=1e-9)


SERIES = {
    "A": walk(3000, 1),
    "B": walk(3000, 2, lead=150),
    "C": walk(6000, 3, gap=2500),
    "D": GAPS,
    "E": walk(2500, 4, holes=0),
    "F": [np.nan] * 5,
}


def test_exponential_mean(spark):
    specs = {"e5": span_alpha(5), "e12": span_alpha(12), "e200": span_alpha(200), "w14": 1 / 14, "half": 0.5, "fast": 0.97}
    for pdf, panel in panels(spark, SERIES):
        got = collected(ewm_mean(panel, {n: ("v", a) for n, a in specs.items()}))
        assert len(got) == len(pdf)
        for n, a in specs.items():
            want = pdf.groupby("Ticker")["v"].transform(lambda x: x.ewm(alpha=a, adjust=False).mean())
            same(got[n], want)


def test_known_gap_values(spark):
    _, frame = frame_of(spark, {"D": GAPS})
    panel = Panel.of(frame, fill={"pad": "v"})
    panel = ewm_mean(panel, {"e": ("v", 0.5)}).with_columns({"chg": panel.change("pad", 1), "r2": panel.rolling(F.avg, "v", 2)})
    got = collected(panel.running_sum({"cum": "v"}))
    np.testing.assert_allclose(got["e"], [10, 10, 34 / 3, 67 / 6, 67 / 6, 67 / 6, 427 / 30], rtol=1e-12)
    same(got["chg"], pd.Series([np.nan, 0, 0.2, -1 / 12, 0, 0, 4 / 11]))
    same(got["cum"], pd.Series([10, np.nan, 22, 33, np.nan, np.nan, 48]))
    same(got["r2"], pd.Series([np.nan, np.nan, np.nan, 11.5, np.nan, np.nan, np.nan]))


def test_running_state(spark):
    for pdf, panel in panels(spark, SERIES, fill={"pad": "v"}):
        got = collected(panel.running_sum({"cum": "v"}))
        g = pdf.groupby("Ticker")["v"]
        same(got["pad"], g.ffill())
        same(got["cum"], g.cumsum())


def test_rolling_frames(spark):
    for pdf, panel in panels(spark, SERIES, fill={"pad": "v"}):
        w = Frames(panel)
        panel = w.apply(
            {
                "mean": w.mean("v", 20),
                "std": w.rolling("stddev_samp", "v", 5),
                "low": w.rolling("min", "v", 14),
                "total": w.rolling("sum", "pad", 50),
                "q20": w.quantile("pad", 0.2, 20),
                "mad": w.mad("v", 20),
                "chg": w.change("pad", 5),
                "diff": F.col("v") - w.lag("v", 3),
                "cov": w.cov("v", "pad", 10),
            }
        )
        got = collected(panel)
        g = pdf.groupby("Ticker")["v"]
        pad = g.ffill()
        gp = pad.groupby(pdf["Ticker"])
        same(got["mean"], g.transform(lambda x: x.rolling(20).mean()))
        same(got["std"], g.transform(lambda x: x.rolling(5).std()), 1e-7)
        same(got["low"], g.transform(lambda x: x.rolling(14).min()))
        same(got["total"], gp.transform(lambda x: x.rolling(50).sum()))
        same(got["q20"], gp.transform(lambda x: x.rolling(20).quantile(0.2)))
        same(got["mad"], g.transform(lambda x: x.rolling(20).apply(lambda y: np.mean(np.abs(y - y.mean())), raw=True)))
        same(got["chg"], gp.transform(lambda x: x / x.shift(5) - 1))
        same(got["diff"], g.diff(3))
        same(got["cov"], pdf.groupby("Ticker", group_keys=False)["v"].apply(lambda x: x.rolling(10).cov(x.ffill())), 1e-6)


def test_one_key_with_most_rows_is_cut(spark):
    series = {"HOT": walk(20_000, 9, holes=0.02), "cold": walk(50, 10)}
    pdf, frame = frame_of(spark, series, minutes=True)
    panel = Panel.of(frame, halo=64, rows_per_segment=1000, bucket_seconds=14_400)
    sizes = panel.frame.groupBy(*panel.group).count().toPandas()
    assert len(sizes) > 15
    assert sizes["count"].max() < 1000 + 3 * 240
    assert panel.result().count() == len(pdf)


def test_looking_ahead_needs_a_calendar_panel(spark):
    _, frame = frame_of(spark, {"A": walk(30, 1)}, minutes=True)
    with pytest.raises(ValueError):
        Panel.of(frame).lead("v", 5)


def test_busy_bucket_is_cut_by_row_number(spark):
    """Most rows in one hour: no segment above its size, copies within the halo only, look-ahead right."""
    hot = spark.range(5000).select(F.lit("A").alias("Ticker"), (F.lit(1_700_000_000) + F.col("id") / 10).cast("timestamp").alias("Date"), "id", F.col("id").cast("double").alias("x"))
    late = spark.range(5000, 5100).select(F.lit("A").alias("Ticker"), (F.lit(1_700_090_000) + F.col("id") * 60).cast("timestamp").alias("Date"), "id", F.col("id").cast("double").alias("x"))
    panel = Panel.of(hot.unionByName(late), order=("Date", "id"), halo=64, rows_per_segment=1000, ahead=5)
    sizes = [r["count"] for r in panel.frame.filter("_core").groupBy("_segment").count().collect()]
    assert max(sizes) <= 1000 and sum(sizes) == 5100
    assert panel.frame.count() <= 5100 + 5 * (64 + 5)
    rows = panel.with_columns({"back": panel.lag("x", 50), "next": panel.lead("x", 5), "mean": panel.rolling(F.avg, "x", 50)}).result().orderBy("id").collect()
    assert [r["back"] for r in rows] == [None] * 50 + [float(k) for k in range(5050)]
    assert [r["next"] for r in rows] == [float(k) for k in range(5, 5100)] + [None] * 5
    assert all(abs(r["mean"] - (r["id"] - 24.5)) < 1e-9 for r in rows[49:])
    with pytest.raises(ValueError):
        panel.lead("x", 6)
