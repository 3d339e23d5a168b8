"""Chains of frames over running state on split panels: equal to the calendar panel, or refused."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators.ewm import ewm_mean
from barloom.operators.panel import Panel

ROWS = 3000


@pytest.fixture(scope="module")
def panels(spark):
    rng = np.random.default_rng(5)
    values = np.cumsum(rng.normal(size=ROWS))
    rows = [("A", dt.date(2000, 1, 1) + dt.timedelta(days=k), None if k % 11 == 3 else float(v), float(v)) for k, v in enumerate(values)]
    daily = spark.createDataFrame(rows, "Ticker string, Date date, v double, x double")
    timed = daily.withColumn("Date", F.col("Date").cast("timestamp"))
    return Panel.of(daily), Panel.of(timed, halo=64, rows_per_segment=300, bucket_seconds=40 * 86_400, ahead=5)


def equal(panels, chain):
    a, b = ([r["out"] for r in chain(p).result().orderBy("Date").select("out").collect()] for p in panels)
    assert [x is None for x in a] == [x is None for x in b]
    np.testing.assert_allclose([x for x in a if x is not None], [x for x in b if x is not None], rtol=1e-9, atol=1e-9)


def test_lag_of_an_exponential_mean(panels):
    equal(panels, lambda p: (q := ewm_mean(p, {"e": ("v", 0.1)})).with_columns({"out": q.lag("e", 5)}))


def test_rolling_mean_of_a_running_sum(panels):
    equal(panels, lambda p: (q := p.running_sum({"s": "x"})).with_columns({"out": q.rolling(F.avg, "s", 10)}))


def test_rolling_mean_of_a_filled_column(panels):
    equal(panels, lambda p: (q := p.forward_fill({"pad": "v"})).with_columns({"out": q.rolling(F.avg, "pad", 30)}))


def test_chain_within_the_halo(panels):
    def chain(p):
        p = p.with_columns({"m": p.rolling(F.avg, "x", 20)})
        p = ewm_mean(p.running_sum({"s": "m"}), {"e": ("s", 0.2)})
        return p.with_columns({"out": p.rolling(F.avg, "e", 30)})

    equal(panels, chain)


def test_chain_longer_than_the_halo_is_refused(panels):
    _, p = panels
    p = p.with_columns({"m": p.rolling(F.avg, "x", 50)})
    with pytest.raises(ValueError, match="98 rows back"):
        p.with_columns({"out": p.rolling(F.avg, "m", 50)})
    p = p.running_sum({"s": "m"})
    with pytest.raises(ValueError, match="halo=64"):
        p.with_columns({"out": F.col("s") - p.lag("s", 40)})


def test_looking_ahead_twice_is_refused(panels):
    _, p = panels
    p = p.with_columns({"next": p.lead("x", 3)})
    with pytest.raises(ValueError, match="6 ahead"):
        p.with_columns({"out": p.lead("next", 3)})
