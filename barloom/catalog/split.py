"""Panel operators on a few very large series: events by type, ordered by time and id.

Five keys hold all rows, so each series is cut into segments; the results must equal plain
windows over the whole series.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.catalog.registry import over, query, rnd, rounded, view
from barloom.operators.ewm import ewm_mean
from barloom.operators.frames import Frames
from barloom.operators.panel import Panel
from barloom.sources import tables

W = "PARTITION BY event_type ORDER BY ts, event_id"
KEYS = ["event_id", "event_type"]
ALPHA = 0.1

view("readings", (), "SELECT event_id, event_type, ts, CASE WHEN event_id % 7 <> 0 THEN value END AS v, value FROM events")
view("readings_padded", ("readings",), f"""
SELECT *, LAST_VALUE(v IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pad FROM readings""")
view("readings_numbered", ("readings",), f"SELECT *, ROW_NUMBER() OVER ({W}) AS rn FROM readings")
view("readings_mean", ("readings_numbered",), f"""RECURSIVE
SELECT event_id, event_type, rn, v AS y, 1.0e0 AS w FROM readings_numbered WHERE rn = 1
UNION ALL
SELECT s.event_id, s.event_type, s.rn,
  CASE WHEN s.v IS NULL THEN e.y WHEN e.y IS NULL THEN s.v
       ELSE (e.w * {1 - ALPHA!r} * e.y + {ALPHA!r} * s.v) / (e.w * {1 - ALPHA!r} + {ALPHA!r}) END,
  CASE WHEN s.v IS NULL AND e.y IS NOT NULL THEN e.w * {1 - ALPHA!r} ELSE 1.0e0 END
FROM readings_mean e JOIN readings_numbered s ON s.event_type = e.event_type AND s.rn = e.rn + 1""")


def readings(spark, sf, fill=False) -> Panel:
    events = tables.given(spark, sf, "events").select(
        "event_id", "event_type", "ts", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("v"), "value"
    )
    return Panel.of(
        events, key="event_type", order=("ts", "event_id"), fill={"pad": "v"} if fill else None,
        halo=64, bucket_seconds=600,
    )


def shown(panel: Panel, *columns: str, digits: int = 6):
    return rounded(panel.result().select(*KEYS, *columns), digits)


def _frame(n: int) -> str:
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _roll(call: str, n: int, counted: str = "value") -> str:
    return f"CASE WHEN COUNT({counted}) OVER {_frame(n)} = {n} THEN {call} OVER {_frame(n)} END"


@query("W-05 W-06 W-09 W-11", over("readings_padded", body=f"""
SELECT event_id, event_type, {rnd(_roll('AVG(value)', 50), 'mean_50')}, {rnd(_roll('STDDEV_SAMP(value)', 20), 'std_20')},
  {rnd(_roll('MAX(value)', 14), 'max_14')}, {rnd(_roll('QUANTILE_CONT(value, 0.2)', 20), 'q20_20')},
  {rnd(_roll('AVG(v)', 3, 'v'), 'mean_3')} FROM readings_padded"""))
def long_series_rolling(spark, sf):
    w = Frames(readings(spark, sf))
    return shown(w.apply({
        "mean_50": w.mean("value", 50), "std_20": w.rolling("stddev_samp", "value", 20),
        "max_14": w.rolling("max", "value", 14), "q20_20": w.quantile("value", 0.2, 20), "mean_3": w.mean("v", 3),
    }), "mean_50", "std_20", "max_14", "q20_20", "mean_3")


@query("W-04 W-15 W-16", over("readings_padded", body=f"""
SELECT event_id, event_type, {rnd('pad')}, {rnd(f'pad / NULLIF(LAG(pad, 5) OVER ({W}), 0) - 1', 'change_5', 4)},
  CASE WHEN v IS NOT NULL THEN ROUND(SUM(v) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) + 0.0 END AS running
FROM readings_padded"""))
def long_series_running_state(spark, sf):
    w = Frames(readings(spark, sf, fill=True))
    p = w.apply({"change_5": w.change("pad", 5)}).running_sum({"running": "v"})
    return rounded(p.result().select(*KEYS, "pad", "change_5", "running"), change_5=4, running=4)


@query("W-13 W-14", over("readings_mean", body=f"SELECT event_id, event_type, {rnd('y', 'mean')} FROM readings_mean"))
def long_series_exponential_mean(spark, sf):
    return shown(ewm_mean(readings(spark, sf), {"mean": ("v", ALPHA)}), "mean")


@query("F-64 W-02 X-15", f"""
SELECT event_id, event_type, {rnd('LEAD(value, 5) OVER ' + '(' + W + ')', 'ahead')},
  CASE WHEN LEAD(value, 5) OVER ({W}) > value * 1.03 THEN 1 ELSE 0 END AS "Target" FROM events""")
def long_series_label(spark, sf):
    """Will the value five readings later be more than 3 % higher: a label on time stamps."""
    events = tables.given(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    panel = Panel.of(events, key="event_type", order=("ts", "event_id"), halo=0, ahead=5, bucket_seconds=600)
    panel = panel.with_columns({"ahead": panel.lead("value", 5)})
    rises = F.coalesce(F.col("ahead") > F.col("value") * 1.03, F.lit(False)).cast("int")
    return shown(panel.with_columns({"Target": rises}), "ahead", "Target")


_SHIPPED = "PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity"


@query("W-01 W-05 W-06", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity, LAG(l_quantity, 40) OVER w AS back,
  CASE WHEN COUNT(*) OVER f = 50 THEN ROUND(AVG(l_quantity) OVER f, 6) + 0.0 END AS mean_50,
  CASE WHEN COUNT(*) OVER f = 50 THEN MAX(l_quantity) OVER f END AS max_50
FROM lineitem WINDOW w AS ({_SHIPPED}), f AS ({_SHIPPED} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)""")
def busy_bucket_rolling(spark, sf):
    """Three keys and buckets of a year: a bucket holds far more rows than a segment."""
    lines = tables.given(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity", F.col("l_shipdate").cast("timestamp").alias("shipped")
    )
    order = ("shipped", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    w = Frames(Panel.of(lines, key="l_returnflag", order=order, halo=64, bucket_seconds=365 * 86_400))
    panel = w.apply({"back": w.lag("l_quantity", 40), "mean_50": w.mean("l_quantity", 50), "max_50": w.rolling("max", "l_quantity", 50)})
    return rounded(panel.result().select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity", "back", "mean_50", "max_50"))
