"""Window primitives over the bars, on a close with holes so that every null rule matters."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.catalog.tables import stored
from barloom.catalog.registry import over, query, rnd, rounded, view
from barloom.functions.nulls import flag
from barloom.operators.ewm import ewm_mean, span_alpha
from barloom.operators.frames import Frames
from barloom.operators.panel import Panel
from barloom.operators.profile import first_valid
from barloom.sources import tables

KEYS = ["Date", "Ticker"]
W = "(PARTITION BY Ticker ORDER BY Date)"

# The close is missing on the 7th and 8th of a month and for a series' first dates in 1995.
view("holes", ("bars",), """
SELECT *, CASE WHEN DAYOFMONTH(Date) IN (7, 8) OR Date < DATE '1995-03-01' THEN NULL ELSE Close END AS v FROM bars""")
view("padded", ("holes",), f"""
SELECT *, LAST_VALUE(v IGNORE NULLS) OVER (PARTITION BY Ticker ORDER BY Date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pad FROM holes""")


def holes(spark, sf):
    missing = F.dayofmonth("Date").isin(7, 8) | (F.col("Date") < F.lit("1995-03-01").cast("date"))
    return stored(spark, sf, "bars").withColumn("v", F.when(~missing, F.col("Close")))


def panel_of(spark, sf, fill=False) -> Panel:
    return Panel.of(holes(spark, sf), fill={"pad": "v"} if fill else None)


def frame(n: int) -> str:
    return f"(PARTITION BY Ticker ORDER BY Date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def roll(call: str, counted: str, n: int) -> str:
    return f"CASE WHEN COUNT({counted}) OVER {frame(n)} = {n} THEN {call} OVER {frame(n)} END"


def shown(panel: Panel, *columns: str, digits: int = 6):
    return rounded(panel.result().select(*KEYS, *columns), digits)


@query("W-01 W-02 W-03 W-17", over("holes", body=f"""
SELECT Date, Ticker, {rnd(f'LAG(v, 1) OVER {W}', 'lag_1')}, {rnd(f'LAG(v, 5) OVER {W}', 'lag_5')},
  {rnd(f'LEAD(v, 5) OVER {W}', 'lead_5')}, {rnd(f'v - LAG(v, 5) OVER {W}', 'diff_5')} FROM holes"""))
def lag_lead_difference(spark, sf):
    p = panel_of(spark, sf)
    p = p.with_columns({"lag_1": p.lag("v"), "lag_5": p.lag("v", 5), "lead_5": p.lead("v", 5), "diff_5": p.diff("v", 5)})
    return shown(p, "lag_1", "lag_5", "lead_5", "diff_5")


@query("W-04 W-16", over("padded", body=f"""
SELECT Date, Ticker, {rnd('pad')}, {rnd(f'pad / LAG(pad, 1) OVER {W} - 1', 'change_1')},
  {rnd(f'pad / LAG(pad, 20) OVER {W} - 1', 'change_20')} FROM padded"""))
def forward_fill_and_change(spark, sf):
    w = Frames(panel_of(spark, sf, fill=True))
    return shown(w.apply({"change_1": w.change("pad", 1), "change_20": w.change("pad", 20)}), "pad", "change_1", "change_20")


@query("W-05 W-06 W-07 W-09 W-10", over("holes", body=f"""
SELECT Date, Ticker, {rnd(roll('AVG(v)', 'v', 5), 'mean_5')}, {rnd(roll('AVG(v)', 'v', 10), 'mean_10')},
  {rnd(roll('STDDEV_SAMP(v)', 'v', 5), 'std_5')}, {rnd(roll('VAR_SAMP(v)', 'v', 10), 'var_10', 0)},
  {rnd(roll('MIN(v)', 'v', 10), 'min_10')}, {rnd(roll('MAX(v)', 'v', 10), 'max_10')},
  {rnd(roll('SUM(v)', 'v', 10), 'sum_10')} FROM holes"""))
def rolling_statistics(spark, sf):
    w = Frames(panel_of(spark, sf))
    p = w.apply({
        "mean_5": w.mean("v", 5), "mean_10": w.mean("v", 10), "std_5": w.rolling("stddev_samp", "v", 5),
        "var_10": w.rolling("var_samp", "v", 10), "min_10": w.rolling("min", "v", 10),
        "max_10": w.rolling("max", "v", 10), "sum_10": w.rolling("sum", "v", 10),
    })
    names = ["mean_5", "mean_10", "std_5", "var_10", "min_10", "max_10", "sum_10"]
    return rounded(p.result().select(*KEYS, *names), var_10=0)


@query("W-08 V-02", over("holes", body=f"""
SELECT Date, Ticker, {rnd(f'CASE WHEN COUNT(CASE WHEN v IS NOT NULL AND Open IS NOT NULL THEN 1 END) OVER {frame(12)} = 12 THEN COVAR_SAMP(v, Open) OVER {frame(12)} END', 'cov_12', 1)}
FROM holes"""))
def rolling_covariance(spark, sf):
    w = Frames(panel_of(spark, sf))
    return shown(w.apply({"cov_12": w.cov("v", "Open", 12)}), "cov_12", digits=1)


@query("W-11", over("padded", body=f"""
SELECT Date, Ticker, {rnd(roll('QUANTILE_CONT(pad, 0.2)', 'pad', 20), 'q20_20')} FROM padded"""))
def rolling_quantile(spark, sf):
    w = Frames(panel_of(spark, sf, fill=True))
    return shown(w.apply({"q20_20": w.quantile("pad", 0.2, 20)}), "q20_20")


@query("W-12 V-01", over("padded", body=f"""
SELECT Date, Ticker, CASE WHEN n = 20 THEN ROUND(list_sum(list_transform(l, lambda x: ABS(x - list_avg(l)))) / 20, 6) + 0.0 END AS mad_20
FROM (SELECT Date, Ticker, LIST(pad) OVER {frame(20)} AS l, COUNT(pad) OVER {frame(20)} AS n FROM padded)"""))
def rolling_mean_absolute_deviation(spark, sf):
    w = Frames(panel_of(spark, sf, fill=True))
    return shown(w.apply({"mad_20": w.mad("pad", 20)}), "mad_20")


@query("W-15", over("holes", body=f"""
SELECT Date, Ticker, CASE WHEN v IS NOT NULL THEN ROUND(SUM(v) OVER (PARTITION BY Ticker ORDER BY Date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) + 0.0 END AS running FROM holes"""))
def cumulative_sum_with_holes(spark, sf):
    return shown(panel_of(spark, sf).running_sum({"running": "v"}), "running", digits=4)


# state: the mean y and the weight w of the past, which decays over missing rows
def _gap_step(name: str, a: float) -> str:
    decayed = f"e.w_{name} * {1 - a!r}"
    return (
        f"CASE WHEN s.v IS NULL THEN e.{name} WHEN e.{name} IS NULL THEN s.v "
        f"ELSE ({decayed} * e.{name} + {a!r} * s.v) / ({decayed} + {a!r}) END AS {name}, "
        f"CASE WHEN s.v IS NULL AND e.{name} IS NOT NULL THEN {decayed} ELSE 1.0e0 END AS w_{name}"
    )


_GAP_MEANS = {"span_5": span_alpha(5), "span_20": span_alpha(20), "span_200": span_alpha(200), "wilder": 1 / 14}
view("numbered", ("holes",), f"SELECT Date, Ticker, v, ROW_NUMBER() OVER {W} AS rn FROM holes")
view("gap_means", ("numbered",), f"""RECURSIVE
SELECT Date, Ticker, rn, {', '.join(f'v AS {n}, 1.0e0 AS w_{n}' for n in _GAP_MEANS)} FROM numbered WHERE rn = 1
UNION ALL
SELECT s.Date, s.Ticker, s.rn, {', '.join(_gap_step(n, a) for n, a in _GAP_MEANS.items())}
FROM gap_means e JOIN numbered s ON s.Ticker = e.Ticker AND s.rn = e.rn + 1""")


@query("W-13 W-14 V-03", over("gap_means", body=f"SELECT Date, Ticker, {', '.join(rnd(n, n, 4) for n in _GAP_MEANS)} FROM gap_means"))
def exponential_means_with_holes(spark, sf):
    return shown(ewm_mean(panel_of(spark, sf), {n: ("v", a) for n, a in _GAP_MEANS.items()}), *_GAP_MEANS, digits=4)


@query("W-18 A-03", over("holes", body="""
SELECT Ticker, MIN(Date) AS First_Valid_Date FROM holes WHERE v IS NOT NULL GROUP BY Ticker"""))
def first_valid_date(spark, sf):
    return first_valid(holes(spark, sf), value="v")


@query("X-15 X-14", over("padded", body="""
SELECT Date, Ticker, CAST(COALESCE(v > pad - 1 AND v > Open, FALSE) AS INTEGER) AS rising FROM padded"""))
def flags_count_unknown_as_zero(spark, sf):
    p = panel_of(spark, sf, fill=True)
    return p.with_columns({"rising": flag((F.col("v") > F.col("pad") - 1) & (F.col("v") > F.col("Open")))}).result().select(*KEYS, "rising")


@query("V-01 V-03", over("padded", body=f"""
SELECT Date, Ticker, CASE WHEN n = 10 THEN ROUND(l[10] - list_max(l), 6) + 0.0 END AS below_best
FROM (SELECT Date, Ticker, LIST(pad) OVER {frame(10)} AS l, COUNT(pad) OVER {frame(10)} AS n FROM padded)"""))
def function_of_a_frame(spark, sf):
    """A user function over the values of each frame: distance of the last value to the best."""
    w = Frames(panel_of(spark, sf, fill=True))
    below = w.values("pad", 10, lambda v: F.element_at(v, -1) - F.array_max(v))
    return shown(w.apply({"below_best": below}), "below_best")


@query("X-11 X-12 X-13", over("holes", body=f"""
SELECT Date, Ticker, {rnd(f'CASE WHEN v IS NOT NULL AND LAG(v) OVER {W} IS NOT NULL THEN GREATEST(v - LAG(v) OVER {W}, 0) END', 'gain')},
  {rnd(f'CASE WHEN v IS NOT NULL AND LAG(v) OVER {W} IS NOT NULL THEN GREATEST(LAG(v) OVER {W} - v, 0) END', 'loss')},
  CAST(SIGN(v - LAG(v) OVER {W}) AS DOUBLE) AS direction, {rnd('ABS(v - Open) / NULLIF(High - Low, 0)', 'share')} FROM holes"""))
def clipped_steps_with_holes(spark, sf):
    from barloom.functions.nulls import negative_part, positive_part, ratio, zero_to_null

    w = Frames(panel_of(spark, sf))
    step = F.col("v") - w.lag("v")
    p = w.apply({
        "gain": positive_part(step), "loss": negative_part(step), "direction": F.signum(step),
        "share": ratio(F.abs(F.col("v") - F.col("Open")), zero_to_null(F.col("High") - F.col("Low"))),
    })
    return shown(p, "gain", "loss", "direction", "share")
