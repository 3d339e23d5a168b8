"""Edge frames for labels, profiles, sinks, sources, scoring, screening and learning metrics."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions import scoring, text
from barloom.functions.nulls import finite, flag, negative_part, positive_part, ratio
from barloom.learning import evaluation, research
from barloom.operators import label, profile
from barloom.operators.features import RESEARCH_FEATURES, SERVING_FEATURES, feature_frame, features, panel_of_bars
from barloom.operators.panel import Panel
from barloom.plans import fundamentals, screening
from barloom.sinks import tables as sinks
from barloom.sources import history, payload, readers
from barloom.sources import tables as given
from barloom.streaming.daily_load import load_landed

DAY = dt.date(2024, 1, 1)


def bars_of(spark, series, **columns):
    rows = []
    for ticker, closes in series.items():
        for i, c in enumerate(closes):
            c = None if c is None else float(c)
            rows.append((DAY + dt.timedelta(days=i), ticker, c, c, c, c, 100))
    return spark.createDataFrame(rows, readers.BARS_SCHEMA)


def one(frame):
    return frame.collect()[0]


def test_null_rules(spark):
    f = spark.createDataFrame([(None, 0.0), (1.0, 0.0), (-3.0, 2.0), (float("inf"), 1.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    got = f.select(ratio(a, b), flag(a > 0), positive_part(a), negative_part(a), finite(a)).collect()
    assert [tuple(r) for r in got[:3]] == [(None, 0, None, None, None), (None, 1, 1.0, 0.0, 1.0), (-1.5, 0, 0.0, 3.0, -3.0)]
    assert got[3][4] is None


def test_feature_sets():
    assert len(RESEARCH_FEATURES) == len(set(RESEARCH_FEATURES)) == 65
    assert len(SERVING_FEATURES) == 30 and set(SERVING_FEATURES) <= set(RESEARCH_FEATURES)


def test_short_series_flat_days_and_rising_only(spark):
    bars = bars_of(spark, {"short": range(1, 11), "up": range(1, 21)})
    names = ["dist_sma_20", "rsi_14", "close_position", "obv", "dist_pivot", "volatility_5d"]
    out = feature_frame(bars, None, names).toPandas().set_index(["Ticker", "Date"]).sort_index()
    assert out["dist_sma_20"].notna().sum() == 1          # only the 20th row of "up"
    assert out["rsi_14"].isna().all()                     # no loss at all: unknown, not 100
    assert out["close_position"].isna().all()             # high equals low
    assert pd.isna(out["obv"].iloc[0]) and out.loc["short", "obv"].iloc[-1] == 900
    assert out.loc["short", "volatility_5d"].isna().sum() == 5


def test_zero_volume_gives_null(spark):
    bars = bars_of(spark, {"a": [1, 2, 3]}).withColumn("Volume", F.when(F.col("Close") == 1, 0).otherwise(5).cast("long"))
    out = feature_frame(bars, None, ["vol_change_1d"]).orderBy("Date").toPandas()["vol_change_1d"]
    assert pd.isna(out[1]) and out[2] == 0


def test_no_look_ahead(spark, sf):
    bars = given.bars(spark, sf)
    names = ["dist_ema_200", "rsi_14", "beta_60d", "bb_squeeze", "macd_signal", "adl"]
    cut = dt.date(1999, 1, 1)
    market = given.market(spark, sf)
    def upto(f):
        return f.filter(F.col("Date") < cut)
    full = upto(feature_frame(bars, market, names)).toPandas()
    part = feature_frame(upto(bars), upto(market), names).toPandas()
    key = ["Ticker", "Date"]
    pd.testing.assert_frame_equal(full.sort_values(key).reset_index(drop=True), part.sort_values(key).reset_index(drop=True))


def test_split_panel_equals_calendar_panel_on_all_features(spark, sf):
    bars = given.bars(spark, sf)
    names = [n for n in RESEARCH_FEATURES if not n.startswith(("mkt", "beta", "alpha", "rs_"))]
    daily = feature_frame(bars, None, names).toPandas()
    stamped = bars.withColumn("Date", F.col("Date").cast("timestamp"))
    panel = panel_of_bars(stamped, halo=256, rows_per_segment=300, bucket_seconds=20 * 86400)
    cut = features(panel, names).result().select("Date", "Ticker", "Open", "High", "Low", "Close", "Volume", *names).toPandas()
    key = ["Ticker", "Date"]
    daily["Date"] = pd.to_datetime(daily["Date"])
    a, b = (x.sort_values(key).reset_index(drop=True) for x in (daily, cut))
    b["Date"] = pd.to_datetime(b["Date"])
    pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-7, atol=1e-6)


def test_one_exchange_for_the_whole_feature_plan(spark, sf):
    plan = feature_frame(given.bars(spark, sf), None, [n for n in RESEARCH_FEATURES if n not in
        ("mkt_return_1d", "mkt_return_5d", "mkt_return_20d", "mkt_above_sma200", "mkt_vol_20d", "beta_60d", "alpha_60d", "rs_vs_mkt_20d")])
    text_plan = plan._jdf.queryExecution().executedPlan().toString()
    # one to build the bars, one on the series key; no Python worker
    assert text_plan.count("Exchange hashpartitioning") == 2
    assert "Python" not in text_plan and "CartesianProduct" not in text_plan


def test_label_tail(spark):
    bars = bars_of(spark, {"a": [100, 100, 100, 100, 100, 104, 102, 100]})
    zero = label.with_target(Panel.of(bars)).result().orderBy("Date").toPandas()["target"].tolist()
    assert zero == [1, 0, 0, 0, 0, 0, 0, 0]
    dropped = label.with_target(Panel.of(bars), tail="drop").result().filter("target is not null").count()
    assert dropped == 3
    train, test = label.split_by_day(bars, DAY + dt.timedelta(days=6), purge=2)
    assert (train.count(), test.count()) == (4, 2)


@pytest.mark.parametrize("gathered", [20_000, 3])
def test_exact_quantiles(spark, monkeypatch, gathered):
    monkeypatch.setattr(profile, "GATHERED", gathered)
    rng = np.random.default_rng(5)
    data = {"spread": rng.normal(size=900) * 10.0 ** rng.integers(-9, 200, 900), "ties": rng.integers(0, 3, 900) * 1.0, "one": np.full(900, 7.5)}
    f = spark.createDataFrame(pd.DataFrame(data)).withColumn("none", F.lit(None).cast("double"))
    got = profile.quantiles_by_counting(f, f.columns, (0, 0.25, 0.5, 0.993, 1), accuracy=50)
    assert got.pop("none") == [None] * 5
    for c, found in got.items():
        np.testing.assert_allclose(found, np.quantile(data[c], (0, 0.25, 0.5, 0.993, 1)), rtol=1e-9)
    assert profile.quantiles_by_counting(f.limit(0), ["one"], (0.5,)) == {"one": [None]}


def test_exact_profile_copies_no_rows_and_sketches_a_column_once(spark, monkeypatch):
    f = spark.createDataFrame([(float(k % 40), k % 3 or None, -0.0 if k % 2 else 0.0) for k in range(200)], "a double, b int, c double")
    made, real = [], F.percentile_approx
    monkeypatch.setattr(profile.F, "percentile_approx", lambda *x: (made.append(x), real(*x))[1])
    monkeypatch.setattr(profile, "GATHERED", 190)
    out = profile.column_profile(f, exact_distinct=True, exact_quantiles=True)
    assert len(made) <= 3  # one for each column, not for each rank
    assert "gid" not in out._jdf.queryExecution().optimizedPlan().toString()  # no copy of every row for each column
    rows = {r["column"]: r for r in out.collect()}
    assert [(rows[c]["distinct"], rows[c]["missing"]) for c in "abc"] == [(40, 0), (2, 67), (1, 0)]
    assert [rows["a"][q] for q in ("q25", "median", "q75")] == list(np.quantile([k % 40 for k in range(200)], (0.25, 0.5, 0.75)))


def test_profiles(spark):
    f = spark.createDataFrame([(1.0, "x"), (2.0, "x"), (10.0, "y"), (None, None)], "v double, k string")
    assert one(profile.skew_table(f, ["v"]))["Skew_Value"] == round(pd.Series([1.0, 2.0, 10.0]).skew(), 1)
    counts = {r["k"]: r["count"] for r in profile.value_counts(f, "k", ["x", "z"]).collect()}
    assert counts == {"x": 2, "z": 0}
    stats = one(profile.column_profile(f, exact_distinct=True))
    assert (stats["count"], stats["missing"], stats["distinct"]) == (3, 1, 3)
    bars = bars_of(spark, {"ok": [None, 1, 2], "hole": [1, None, 2]})
    assert [r["Ticker"] for r in profile.gaps_after_listing(bars).collect()] == ["hole"]
    again = [profile.repeatable_sample(bars.repartition(n), 3, 10, "Ticker", "Date").collect() for n in (1, 5)]
    assert again[0] == again[1]


def test_replace_days_and_keys(spark, tmp_path):
    path = str(tmp_path / "bars")
    first = bars_of(spark, {"A": [1, 2], "B": [3, 4]})
    assert sinks.replace_days(first, path) and not sinks.replace_days(first.filter("false"), path)
    sinks.replace_days(first, path)
    assert spark.read.parquet(path).count() == 4
    lagging = bars_of(spark, {"A": [9]})
    sinks.replace_keys(lagging, path)
    got = {(r["Ticker"], str(r["Date"])): r["Close"] for r in spark.read.parquet(path).collect()}
    assert len(got) == 4 and got[("A", "2024-01-01")] == 9 and got[("B", "2024-01-01")] == 3
    sinks.replace_days(lagging, path)  # whole days: the other series of that day goes
    assert spark.read.parquet(path).count() == 3


def test_append_keeps_repeats(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = bars_of(spark, {"A": [1]})
    sinks.append_raw(rows, path, "Date")
    sinks.append_raw(rows, path, "Date")
    assert not sinks.append_raw(rows.filter("false"), path, "Date")
    stored = spark.read.parquet(path)
    assert stored.count() == 2 and dict(stored.dtypes)["Date"] == "timestamp"


def test_streamed_load_twice(spark, tmp_path):
    landed, table, mark = (str(tmp_path / n) for n in ("landed", "table", "mark"))
    for closes in ([1, 2, 3], [7]):
        bars_of(spark, {"A": closes}).write.mode("append").parquet(landed)
        load_landed(spark, landed, readers.BARS_SCHEMA, table, mark).awaitTermination()
    got = [r["Close"] for r in spark.read.parquet(table).orderBy("Date").collect()]
    assert got == [7.0, 2.0, 3.0]


def test_payload(spark):
    bodies = [
        ("summary_detail", '{"A": {"marketCap": 5, "trailingPE": 2.5}, "B": "Quote not found", "C": {"marketCap": 7}}'),
        ("financial_data", '{"A": {"returnOnEquity": 0.5}, "C": "error"}'),
        ("price", '{"A": {"shortName": "Aa"}}'),
    ]
    found = payload.entries(spark.createDataFrame(bodies, "module string, body string"))
    rows = payload.fundamentals(found, DAY).collect()
    assert [(r["Ticker"], r["Company_Name"], r["Market_Cap"], r["ROE"], r["Beta"]) for r in rows] == [("A", "Aa", 5.0, 0.5, None)]
    listed = readers.universe(spark, ["A", "B", "Z"])
    assert sorted(r["Ticker"] for r in payload.fundamentals(found, DAY, listed).collect()) == ["A", "Z"]


def test_history(spark):
    wide = spark.createDataFrame([(DAY, 1.0, None), (DAY + dt.timedelta(1), None, None)], "Date date, A_Close double, B_Close double")
    got = history.wide_to_long(wide, ["A", "B"], ["Close"]).collect()
    assert {(r["Ticker"], r["Close"]) for r in got} == {("A", 1.0), ("A", None)}
    lag = bars_of(spark, {"late": [1], "new": [1, 2]})
    assert readers.latest_per_series(lag).count() == 2 and readers.latest_day(lag).count() == 1


def test_scores(spark, sf):
    raw = given.fundamentals(spark, sf)
    out = fundamentals.scored(raw).agg(F.max("Fundamental_Score").alias("m"), F.count_if(F.col("Fundamental_Score").isNull()).alias("n"))
    assert one(out)["m"] <= 100
    edge = spark.createDataFrame([(0.0, None, 1.0), (-1.0, 2e9, 0.99), (25.0, 200e9, None)], "pe double, cap double, cr double")
    got = edge.select(scoring.valuation_category(F.col("pe")), scoring.market_cap_category(F.col("cap")), scoring.liquidity_health(F.col("cr"))).collect()
    assert [tuple(r) for r in got] == [("Unknown", "Small Cap", "Adequate"), ("Negative Earnings", "Mid Cap", "High Risk"), ("Fair", "Mega Cap", "Unknown")]


def test_screen(spark):
    f = spark.createDataFrame(
        [("a", "s", 80.0, 1, 0.9), ("b", "s", None, 0, 0.0), ("c", None, 75.0, 0, 0.1), ("d", "t", 50.0, 1, 0.5)],
        "Ticker string, Sector string, Fundamental_Score double, Prediction int, Probability double")
    assert [r["Ticker"] for r in screening.filtered(f).orderBy("Ticker").collect()] == ["a", "b", "c"]
    assert [r["Ticker"] for r in screening.top_by_score(f, 4).collect()] == ["d", "c", "a", "b"]
    q = {r["Category"]: (r["count"], r["tickers"]) for r in screening.quadrants(f).collect()}
    assert q[screening.STRONG_BUY] == (1, "a") and q[screening.FUNDAMENTAL_STRONG] == (1, "c") and q[screening.WATCH_LIST] == (1, "b")
    assert {r["Signal"]: r["count"] for r in screening.signal_distribution(f.filter("Prediction = 1")).collect()} == {"Potential": 2, "Non Potential": 0}
    with pytest.raises(ValueError):
        screening.compare(f, ["a"])


def test_report(spark):
    f = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "target int, Prediction int")
    rows = {r["class"]: r for r in evaluation.report(evaluation.confusion(f)).collect()}
    assert rows["1"]["precision"] == 0 and rows["0"]["recall"] == 1 and rows["accuracy"]["support"] == 3
    assert len(research.draws(20)) == 20 and research.draws(5) == research.draws(5)
    assert len(research.draws(100)) == 72


def test_day_functions(spark):
    f = spark.sql("select timestamp '2024-01-02 06:59:00' a, timestamp '2024-01-02 07:00:00' b, 1234567.0D n, cast(null as double) x")
    got = one(f.select(text.effective_day(F.col("a")), text.effective_day(F.col("b")), text.grouped(F.col("n")), text.percent(F.lit(0.254)), text.fixed(F.col("x"))))
    assert tuple(got) == (dt.date(2024, 1, 1), dt.date(2024, 1, 2), "1,234,567", "25.4%", None)


def test_null_keys_replay_and_unreadable_tables(spark, tmp_path):
    path = str(tmp_path / "null_keys")
    d = dt.date(2024, 1, 2)
    rows = [(d, "A", 1.0), (d, None, 2.0), (None, "A", 3.0), (None, "B", 4.0)]
    batch = spark.createDataFrame(rows, "Date date, Ticker string, Close double")
    for _ in range(3):
        sinks.replace_keys(batch, path)
        assert sorted(map(str, spark.read.parquet(path).select(*batch.columns).collect())) == sorted(map(str, batch.collect()))
    sinks.replace_keys(batch.filter("Date IS NULL AND Ticker = 'A'").withColumn("Close", F.lit(9.0)), path)
    assert {(r["Ticker"], r["Close"]) for r in spark.read.parquet(path).filter("Date IS NULL").collect()} == {("A", 9.0), ("B", 4.0)}
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("this is no table")
    with pytest.raises(Exception):
        sinks.replace_keys(batch, str(broken))
    assert not sinks.table_exists(spark, str(tmp_path / "nothing"))


def test_first_batch_of_keys_is_written_once(spark, tmp_path, monkeypatch):
    path, made, real = str(tmp_path / "bars"), [], sinks.shared_dir
    monkeypatch.setattr(sinks, "shared_dir", lambda *x: (made.append(x[1]), real(*x))[1])
    batch = bars_of(spark, {"a": [100, 101], "b": [7]})
    assert sinks.replace_keys(batch.unionByName(batch), path) and made == []
    assert sinks.replace_keys(batch.filter("Ticker = 'b'").withColumn("Close", F.lit(9.0)), path) and made == ["landed", "staging"]
    assert sorted((r["Ticker"], r["Close"]) for r in spark.read.parquet(path).collect()) == [("a", 100), ("a", 101), ("b", 9)]
