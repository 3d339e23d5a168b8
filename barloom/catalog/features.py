"""Feature families and the assembled feature sets over all bars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from barloom.catalog.panel import KEYS, W, frame, roll
from barloom.catalog.tables import stored
from barloom.catalog.registry import over, query, rnd, rounded, view
from barloom.operators import state as running
from barloom.operators.ewm import span_alpha
from barloom.operators.features import (
    RESEARCH_FEATURES, SERVING_FEATURES, feature_frame, index, levels, momentum, price, trend, volatility, volume,
)
from barloom.operators.label import split_by_day, with_target
from barloom.operators.panel import Panel
from barloom.session import shared_dir
from barloom.sources import tables

# Running lines grow with volume, so they are compared at fewer digits.
COARSE = {"obv": 2, "vpt": 2, "adl": 2}


def _bars(spark, sf):
    bars = stored(spark, sf, "bars")
    return bars, stored(spark, sf, "market")


def family(spark, sf, names, fill_market=False):
    bars, market = _bars(spark, sf)
    needs_index = bool(set(names) & set(index.OUTPUTS))
    out = feature_frame(bars, market if needs_index else None, names, fill_market)
    return rounded(out.select(*KEYS, *names), **COARSE)


# ---- statements -------------------------------------------------------------------------

view("steps", ("bars",), f"""
SELECT *, LAG(Close) OVER {W} AS pc, LAG(High) OVER {W} AS ph, LAG(Low) OVER {W} AS pl,
  Close / LAG(Close, 1) OVER {W} - 1 AS return_1d, Close / LAG(Close, 3) OVER {W} - 1 AS return_3d,
  Close / LAG(Close, 5) OVER {W} - 1 AS return_5d, Close / LAG(Close, 10) OVER {W} - 1 AS return_10d,
  Close / LAG(Close, 20) OVER {W} - 1 AS return_20d, (High + Low + Close) / 3 AS tp,
  Close - LAG(Close) OVER {W} AS step, High - Low AS spread, ROW_NUMBER() OVER {W} AS rn
FROM bars""")

view("f_price", ("steps",), """
SELECT Date, Ticker, return_1d, return_3d, return_5d, return_10d, return_20d, (Open - pc) / pc AS overnight_gap,
  ABS(Close - Open) / Open AS body_size, (High - GREATEST(Close, Open)) / Open AS upper_shadow,
  (LEAST(Close, Open) - Low) / Open AS lower_shadow, spread / Open AS hl_range,
  (Close - Low) / NULLIF(spread, 0) AS close_position FROM steps""")

_A = {"e5": span_alpha(5), "e10": span_alpha(10), "e20": span_alpha(20), "e50": span_alpha(50), "e200": span_alpha(200),
      "e12": span_alpha(12), "e26": span_alpha(26)}
_S9, _WI = span_alpha(9), 1 / 14
_TR = "CASE WHEN s.pc IS NULL THEN s.spread ELSE GREATEST(s.spread, ABS(s.High - s.pc), ABS(s.Low - s.pc)) END"


def _mix(a: float, x: str, y: str) -> str:
    return f"{1 - a!r} * {y} + {a!r} * {x}"


view("means", ("steps",), f"""RECURSIVE
SELECT Date, Ticker, rn, {', '.join(f'Close AS {n}' for n in _A)}, 0.0e0 AS macd_signal, spread AS atr,
  CAST(NULL AS DOUBLE) AS up, CAST(NULL AS DOUBLE) AS down FROM steps WHERE rn = 1
UNION ALL
SELECT s.Date, s.Ticker, s.rn, {', '.join(_mix(a, 's.Close', 'e.' + n) + ' AS ' + n for n, a in _A.items())},
  {_mix(_S9, '((' + _mix(_A['e12'], 's.Close', 'e.e12') + ') - (' + _mix(_A['e26'], 's.Close', 'e.e26') + '))', 'e.macd_signal')},
  {_mix(_WI, _TR, 'e.atr')},
  CASE WHEN e.up IS NULL THEN GREATEST(s.step, 0.0) ELSE {_mix(_WI, 'GREATEST(s.step, 0.0)', 'e.up')} END,
  CASE WHEN e.down IS NULL THEN GREATEST(-s.step, 0.0) ELSE {_mix(_WI, 'GREATEST(-s.step, 0.0)', 'e.down')} END
FROM means e JOIN steps s ON s.Ticker = e.Ticker AND s.rn = e.rn + 1""")

_SMA = {n: roll("AVG(Close)", "Close", n) for n in trend.AVERAGE_ROWS}
view("averages", ("steps", "means"), f"""
SELECT s.Date, s.Ticker, s.Close, {', '.join(f'm.e{n} AS ema_{n}' for n in trend.AVERAGE_ROWS)}, {', '.join(f'{x} AS sma_{n}' for n, x in
  {n: roll('AVG(s.Close)', 's.Close', n).replace('Ticker', 's.Ticker').replace('Date', 's.Date') for n in trend.AVERAGE_ROWS}.items())}
FROM steps s JOIN means m ON s.Date = m.Date AND s.Ticker = m.Ticker""")
view("f_trend", ("averages",), f"""
SELECT Date, Ticker, {', '.join(f'(Close - {k}_{n}) / {k}_{n} AS dist_{k}_{n}' for n in trend.AVERAGE_ROWS for k in ('sma', 'ema'))},
  ema_5 / ema_20 AS crossover_ema_5_20, sma_50 / sma_200 AS crossover_sma_50_200,
  CAST(COALESCE(sma_50 > sma_200, FALSE) AS INTEGER) AS bullish_regime,
  (sma_20 - LAG(sma_20, 5) OVER {W}) / LAG(sma_20, 5) OVER {W} AS sma20_slope_5d FROM averages""")

view("f_volatility0", ("steps",), f"""
SELECT Date, Ticker, Close, {', '.join(f"{roll('STDDEV_SAMP(return_1d)', 'return_1d', n)} AS volatility_{n}d" for n in (5, 10, 20))}
FROM steps""")
view("f_volatility", ("f_volatility0", "means"), """
SELECT v.Date, v.Ticker, volatility_5d, volatility_10d, volatility_20d, m.atr AS atr_14, m.atr / Close AS atr_pct,
  volatility_5d / NULLIF(volatility_20d, 0) AS vol_ratio_5_20
FROM f_volatility0 v JOIN means m ON v.Date = m.Date AND v.Ticker = m.Ticker""")

view("f_momentum0", ("steps",), f"""
SELECT *, {roll('MIN(Low)', 'Low', 14)} AS lo, {roll('MAX(High)', 'High', 14)} AS hi, {roll('AVG(tp)', 'tp', 20)} AS tpm,
  CASE WHEN rn >= 20 THEN (SELECT list_avg(list_transform(l, lambda x: ABS(x - list_avg(l))))) END AS mad
FROM (SELECT *, LIST(tp) OVER {frame(20)} AS l FROM steps)""")
view("f_momentum1", ("f_momentum0", "means"), f"""
SELECT f.*, 100 * (f.Close - lo) / NULLIF(hi - lo, 0) AS stoch_k, m.e12 - m.e26 AS macd, m.macd_signal AS macd_signal,
  100 - 100 / (1 + m.up / NULLIF(m.down, 0)) AS rsi_14
FROM f_momentum0 f JOIN means m ON f.Date = m.Date AND f.Ticker = m.Ticker""")
view("f_momentum", ("f_momentum1",), f"""
SELECT Date, Ticker, rsi_14, stoch_k, {roll('AVG(stoch_k)', 'stoch_k', 3)} AS stoch_d, macd, macd_signal,
  macd - macd_signal AS macd_hist,
  CAST(COALESCE(macd > macd_signal AND LAG(macd) OVER {W} <= LAG(macd_signal) OVER {W}, FALSE) AS INTEGER) AS macd_cross_up,
  {', '.join(f'(Close - LAG(Close, {n}) OVER {W}) / NULLIF(LAG(Close, {n}) OVER {W}, 0) AS roc_{n}' for n in (5, 10, 20))},
  -100 * (hi - Close) / NULLIF(hi - lo, 0) AS williams_r, (tp - tpm) / (0.015 * NULLIF(mad, 0)) AS cci_20
FROM f_momentum1""")

_CUM = "(PARTITION BY Ticker ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
view("flows", ("steps",), f"""
SELECT *, ((Close - Low) - (High - Close)) / NULLIF(spread, 0) * Volume AS flow, SIGN(step) * Volume AS signed,
  return_1d * Volume AS weighted, Volume / CAST(LAG(Volume) OVER {W} AS DOUBLE) - 1 AS vol_change_1d FROM steps""")
view("f_volume", ("flows",), f"""
SELECT Date, Ticker, Volume / NULLIF({roll('AVG(Volume)', 'Volume', 20)}, 0) AS vol_ratio, vol_change_1d,
  CAST(CASE WHEN signed IS NOT NULL THEN SUM(signed) OVER {_CUM} END AS DOUBLE) AS obv,
  CASE WHEN weighted IS NOT NULL THEN SUM(weighted) OVER {_CUM} END AS vpt,
  CASE WHEN flow IS NOT NULL THEN SUM(flow) OVER {_CUM} END AS adl,
  {roll('SUM(flow)', 'flow', 20)} / NULLIF(CAST({roll('SUM(Volume)', 'Volume', 20)} AS DOUBLE), 0) AS cmf_20 FROM flows""")

view("f_bands0", ("steps",), f"""
SELECT Date, Ticker, Close, {roll('AVG(Close)', 'Close', 20)} AS mid, {roll('STDDEV_SAMP(Close)', 'Close', 20)} AS sd FROM steps""")
view("f_bands1", ("f_bands0",), """
SELECT Date, Ticker, 4 * sd / mid AS bb_width, (Close - (mid - 2 * sd)) / NULLIF(4 * sd, 0) AS bb_pct FROM f_bands0""")
view("f_bands", ("f_bands1",), f"""
SELECT *, CAST(COALESCE(bb_width < {roll('QUANTILE_CONT(bb_width, 0.2)', 'bb_width', 20)}, FALSE) AS INTEGER) AS bb_squeeze FROM f_bands1""")

_O = "(ORDER BY Date)"


def _iroll(call: str, counted: str, n: int) -> str:
    w = f"(ORDER BY Date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN COUNT({counted}) OVER {w} = {n} THEN {call} OVER {w} END"


view("index1", ("market",), f"""
SELECT Date, DJIA_Close, {', '.join(f'DJIA_Close / LAG(DJIA_Close, {n}) OVER {_O} - 1 AS mkt_return_{n}d' for n in (1, 5, 20))},
  {_iroll('AVG(DJIA_Close)', 'DJIA_Close', 50)} AS mkt_sma50, {_iroll('AVG(DJIA_Close)', 'DJIA_Close', 200)} AS mkt_sma200
FROM market""")
view("f_index", ("index1",), f"""
SELECT Date, mkt_return_1d, mkt_return_5d, mkt_return_20d, CAST(COALESCE(DJIA_Close > mkt_sma200, FALSE) AS INTEGER) AS mkt_above_sma200,
  {_iroll('STDDEV_SAMP(mkt_return_1d)', 'mkt_return_1d', 20)} AS mkt_vol_20d, mkt_sma50, mkt_sma200 FROM index1""")

_I = ("mkt_return_1d", "mkt_return_5d", "mkt_return_20d", "mkt_above_sma200", "mkt_vol_20d")
view("joined", ("steps", "f_index"), f"""
SELECT s.Date, s.Ticker, s.return_1d, s.return_20d, {', '.join(f'i.{c} AS {c}' for c in _I)}
FROM steps s LEFT JOIN f_index i ON s.Date = i.Date""")
_FILLED = ("mkt_return_1d", "mkt_above_sma200", "mkt_vol_20d")
view("joined_filled", ("joined",), f"""
SELECT Date, Ticker, return_1d, return_20d, mkt_return_5d, mkt_return_20d,
  {', '.join(f'LAST_VALUE({c} IGNORE NULLS) OVER {_CUM} AS {c}' for c in _FILLED)} FROM joined""")


def _relative(source: str) -> str:
    both = "CASE WHEN return_1d IS NOT NULL AND mkt_return_1d IS NOT NULL THEN 1 END"
    beta = (f"{roll('COVAR_SAMP(return_1d, mkt_return_1d)', both, 60)} / "
            f"NULLIF({roll('VAR_SAMP(mkt_return_1d)', 'mkt_return_1d', 60)}, 0)")
    return f"""
SELECT *, return_1d - beta_60d * mkt_return_1d AS alpha_60d, return_20d - mkt_return_20d AS rs_vs_mkt_20d
FROM (SELECT *, {beta} AS beta_60d FROM {source})"""


view("f_relative", ("joined",), _relative("joined"))
view("f_relative_filled", ("joined_filled",), _relative("joined_filled"))

view("f_levels0", ("steps",), "SELECT *, (ph + pl + pc) / 3 AS p FROM steps")
view("f_levels", ("f_levels0",), """
SELECT Date, Ticker, (Close - p) / NULLIF(p, 0) AS dist_pivot, (2 * p - pl - Close) / NULLIF(Close, 0) AS dist_r1,
  (Close - (2 * p - ph)) / NULLIF(Close, 0) AS dist_s1, (p + (ph - pl) - Close) / NULLIF(Close, 0) AS dist_r2,
  (Close - (p - (ph - pl))) / NULLIF(Close, 0) AS dist_s2 FROM f_levels0""")

FLAGS = {"bullish_regime", "macd_cross_up", "bb_squeeze", "mkt_above_sma200"}


def columns(names, prefix="") -> str:
    return ", ".join(f"{prefix}{n} AS {n}" if n in FLAGS else rnd(prefix + n, n, COARSE.get(n, 6)) for n in names)


def family_sql(name: str, names) -> str:
    return over(name, body=f"SELECT Date, Ticker, {columns(names)} FROM {name}")


# ---- families -----------------------------------------------------------------------------

_PRICE, _TREND, _VOL, _MOM = price.OUTPUTS, trend.OUTPUTS, volatility.OUTPUTS, momentum.OUTPUTS


@query("F-01 F-02 F-03 F-04 F-05 F-06 F-07 F-08 F-09 F-10 F-11 X-11", family_sql("f_price", _PRICE))
def price_features(spark, sf):
    return family(spark, sf, _PRICE)


@query("F-12 F-13 F-14 F-15 F-16 F-17", family_sql("f_trend", _TREND))
def trend_features(spark, sf):
    return family(spark, sf, _TREND)


@query("F-18 F-19 F-20 F-21 F-22", family_sql("f_volatility", _VOL))
def volatility_features(spark, sf):
    return family(spark, sf, _VOL)


@query("F-23 F-24 F-25 F-26 F-27 F-28 F-29 F-30 F-31 F-32 X-12 X-13", family_sql("f_momentum", _MOM))
def momentum_features(spark, sf):
    return family(spark, sf, _MOM)


@query("F-33 F-34 F-35 F-36 F-37 F-38 F-39 F-40", family_sql("f_volume", volume.OUTPUTS))
def volume_features(spark, sf):
    return family(spark, sf, volume.OUTPUTS)


@query("F-41 F-42 F-43 F-44", family_sql("f_bands", volatility.BAND_OUTPUTS))
def band_features(spark, sf):
    return family(spark, sf, volatility.BAND_OUTPUTS)


@query("F-45 F-46 F-47 F-48 F-49 F-50 F-51", over(
    "f_index", body=f"SELECT Date, {columns([*_I, 'mkt_sma50', 'mkt_sma200'])} FROM f_index"))
def index_features(spark, sf):
    return rounded(index.index_features(_bars(spark, sf)[1]))


@query("F-52 F-53 F-55 F-56 F-57 J-01", family_sql("f_relative", index.OUTPUTS))
def relative_features_training(spark, sf):
    return family(spark, sf, index.OUTPUTS)


@query("F-52 F-53 F-54 F-55 J-01 W-16", family_sql("f_relative_filled", ("mkt_above_sma200", "mkt_vol_20d", "beta_60d", "alpha_60d")))
def relative_features_serving(spark, sf):
    return family(spark, sf, ("mkt_above_sma200", "mkt_vol_20d", "beta_60d", "alpha_60d"), fill_market=True)


@query("F-58 F-59 F-60 F-61 F-62 F-63", family_sql("f_levels", levels.OUTPUTS))
def level_features(spark, sf):
    return family(spark, sf, levels.OUTPUTS)


# ---- assembled sets -------------------------------------------------------------------------

_FROM = {
    "p": ("f_price", _PRICE), "t": ("f_trend", _TREND), "v": ("f_volatility", _VOL), "m": ("f_momentum", _MOM),
    "o": ("f_volume", volume.OUTPUTS), "b": ("f_bands", volatility.BAND_OUTPUTS), "l": ("f_levels", levels.OUTPUTS),
}


def assembled_sql(names, relative: str, extra: str = "", where: str = "") -> str:
    sources = _FROM | {"r": (relative, index.OUTPUTS)}
    parts = []
    for a, (_, outputs) in sources.items():
        mine = [n for n in outputs if n in names]
        if mine:
            parts.append(columns(mine, f"{a}."))
    joins = " ".join(
        f"JOIN {t} {a} ON s.Date = {a}.Date AND s.Ticker = {a}.Ticker" for a, (t, _) in sources.items()
    )
    return over("steps", *[t for t, _ in sources.values()],
                body=f"SELECT s.Date, s.Ticker, {', '.join(parts)}{extra} FROM steps s {joins} {where}")


@query("F-01..F-62 serving set", assembled_sql(SERVING_FEATURES, "f_relative_filled"))
def serving_features(spark, sf):
    """The 30 features of the deployed model."""
    return family(spark, sf, SERVING_FEATURES, fill_market=True)


@query("F-01..F-63 research set", assembled_sql(RESEARCH_FEATURES, "f_relative"))
def research_features(spark, sf):
    """All 65 candidate features."""
    return family(spark, sf, RESEARCH_FEATURES)


# ---- labels ----------------------------------------------------------------------------------


@query("F-64 W-02 X-15", over("steps", body=f"""
SELECT Date, Ticker, CAST(COALESCE(LEAD(Close, 5) OVER {W} / Close - 1 > 0.03, FALSE) AS INTEGER) AS target FROM steps"""))
def forward_label(spark, sf):
    return with_target(Panel.of(stored(spark, sf, "bars"))).result().select(*KEYS, "target")


@query("F-64 P-13 M-01 M-04", over("steps", body=f"""
SELECT part, target, COUNT(*) AS "rows", ROUND(ANY_VALUE(total) / (2.0 * COUNT(*)), 6) + 0.0 AS class_weight
FROM (SELECT part, target, COUNT(*) OVER (PARTITION BY part) AS total FROM
  (SELECT CASE WHEN Date < DATE '2000-06-01' THEN 'train' ELSE 'test' END AS part,
          CAST(COALESCE(LEAD(Close, 10) OVER {W} / Close - 1 > 0.05, FALSE) AS INTEGER) AS target FROM steps))
GROUP BY part, target"""))
def label_balance_by_period(spark, sf):
    """Labels with another horizon and threshold, split by day, with balanced class weights."""
    import datetime as dt

    from barloom.learning.model import WEIGHT, with_class_weight

    rows = with_target(Panel.of(stored(spark, sf, "bars")), horizon=10, threshold=0.05).result()
    parts = split_by_day(rows.select("Date", "target"), dt.date(2000, 6, 1))
    out = [with_class_weight(p).select(F.lit(n).alias("part"), "target", WEIGHT) for n, p in zip(("train", "test"), parts)]
    return rounded(
        out[0].unionByName(out[1]).groupBy("part", "target")
        .agg(F.count(F.lit(1)).alias("rows"), F.max(WEIGHT).alias("class_weight"))
    )


@query("F-64 W-02", over("steps", body=f"""
SELECT Date, Ticker, target FROM (SELECT Date, Ticker, LEAD(1, 5) OVER {W} AS later,
  CAST(COALESCE(LEAD(Close, 5) OVER {W} / Close - 1 > 0.03, FALSE) AS INTEGER) AS target FROM steps) WHERE later IS NOT NULL"""))
def forward_label_without_tail(spark, sf):
    panel = with_target(Panel.of(stored(spark, sf, "bars")), tail="drop")
    return panel.result().select(*KEYS, "target").na.drop()


@query("P-06 P-15 P-02 F-64", assembled_sql(
    SERVING_FEATURES, "f_relative_filled",
    extra=f", y.target AS target",
    where=f"""JOIN (SELECT Date, Ticker, CAST(COALESCE(LEAD(Close, 5) OVER {W} / Close - 1 > 0.03, FALSE) AS INTEGER) AS target FROM steps) y
ON y.Date = s.Date AND y.Ticker = s.Ticker WHERE """ + " AND ".join(
        f"{a}.{n} IS NOT NULL" for a, (_, outs) in (_FROM | {"r": ("", index.OUTPUTS)}).items() for n in outs if n in SERVING_FEATURES)))
def training_rows(spark, sf):
    """Features and label of every complete row, raw columns dropped."""
    from barloom.catalog.learning import training_frame

    return rounded(training_frame(spark, sf), **COARSE)


# ---- features from a stored state ------------------------------------------------------------

# running lines, exponential means (one of them of another), long frames and chains, index columns
RESUMED = (
    "obv", "vpt", "adl", "dist_ema_10", "crossover_ema_5_20", "atr_pct", "rsi_14", "macd_signal", "crossover_sma_50_200",
    "sma20_slope_5d", "beta_60d", "mkt_above_sma200", "mkt_vol_20d",
)


@query("Q-05 M-07 S-08 W-13 W-15 W-16", assembled_sql(
    RESUMED, "f_relative_filled", where="WHERE s.Date >= (SELECT MIN(Date) FROM (SELECT DISTINCT Date FROM bars ORDER BY Date DESC LIMIT 30))"))
def resumed_features(spark, sf):
    """The last 30 days' features, delivered in two parts behind a state of the history before."""
    bars, market = _bars(spark, sf)
    days = [r["Date"] for r in bars.select("Date").distinct().orderBy(F.desc("Date")).limit(30).collect()][::-1]
    path, out = shared_dir(spark, "feature-state"), None
    parts = [(None, days[0]), (days[0], days[1]), (days[1], None)]
    for first, behind in parts:
        span = [f for f in (bars, market)]
        if first:
            span = [f.filter(F.col("Date") >= F.lit(first)) for f in span]
        if behind:
            span = [f.filter(F.col("Date") < F.lit(behind)) for f in span]
        before = running.load_state(spark, path, first) if first else None
        rows, after = running.advance(*span, RESUMED, before, fill_market=True)
        if behind:
            running.save_state(after, path, behind - dt.timedelta(days=1))
        if first:
            out = rows if out is None else out.unionByName(rows)
    return rounded(out.select(*KEYS, *RESUMED), **COARSE)
