"""Fundamental categories and the 0-100 fundamental score, as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Mapping, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


def stepped(value: Column, floors: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first floor (highest first) the value reaches; NULL gets `otherwise`."""
    label = F.lit(otherwise)
    for floor, name in reversed(floors):
        label = F.when(value >= floor, name).otherwise(label)
    return label


# Category borders and labels.
MARKET_CAP_FLOORS = [(200e9, "Mega Cap"), (10e9, "Large Cap"), (2e9, "Mid Cap")]
LIQUIDITY_FLOORS = [(1.5, "Healthy"), (1.0, "Adequate")]
VALUATION_CEILINGS = [(15, "Value"), (25, "Fair")]


def market_cap_category(cap: Column) -> Column:
    return stepped(cap, MARKET_CAP_FLOORS, "Small Cap")


def liquidity_health(current_ratio: Column) -> Column:
    return F.when(current_ratio.isNull(), "Unknown").otherwise(stepped(current_ratio, LIQUIDITY_FLOORS, "High Risk"))


def valuation_category(pe: Column) -> Column:
    """Exactly zero counts as unknown, like NULL."""
    label = F.lit("Growth/Overvalued")
    for ceiling, name in reversed(VALUATION_CEILINGS):
        label = F.when(pe <= ceiling, name).otherwise(label)
    return (
        F.when(pe.isNull() | (pe == 0), "Unknown")
        .when(pe < 0, "Negative Earnings")
        .otherwise(label)
    )


class Term(NamedTuple):
    metric: str
    default: float  # taken where the metric is missing
    scale: float    # value at which a rising term reaches, or a falling term leaves, its range
    points: float
    kind: str       # "cap": at most points; "floor": falls from points, at least 0; "both"


# The ten terms of the score.
SCORE_TERMS = [
    Term("ROE", 0, 40, 15, "cap"),
    Term("Gross_Margin", 0, 75, 10, "cap"),
    Term("Profit_Margin", 0, 35, 10, "cap"),
    Term("Earnings_Growth", 0, 45, 5, "cap"),
    Term("Forward_PE", 30, 40, 15, "floor"),
    Term("Price_to_Book", 5, 15, 10, "floor"),
    Term("PEG_Ratio", 2, 4, 5, "floor"),
    Term("Current_Ratio", 1, 4, 10, "cap"),
    Term("Debt_to_Equity", 1, 3, 10, "floor"),
    Term("Fifty_Two_Week_Change", 0, 60, 10, "both"),
]
REQUIRED_METRICS = ["ROE", "Gross_Margin", "Profit_Margin", "Forward_PE", "Current_Ratio"]
MAX_SCORE = 100.0


def _points(term: Term, unit: float) -> Column:
    value = F.coalesce(F.col(term.metric) * unit if unit != 1 else F.col(term.metric), F.lit(float(term.default)))
    if term.kind == "floor":
        return F.greatest(F.lit(0.0), (term.scale - value) / term.scale * term.points)
    if term.kind == "both":
        value = F.greatest(value, F.lit(0.0))
    return F.least(value / term.scale * term.points, F.lit(float(term.points)))


def fundamental_score(units: Mapping[str, float] | None = None) -> Column:
    """Score rounded to one decimal; NULL if a required metric is missing.

    `units` rescales a metric before scoring (100 turns fractions into percent); the default
    takes the values as they are.
    """
    units = units or {}
    total = reduce(add, [_points(t, units.get(t.metric, 1)) for t in SCORE_TERMS])
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in REQUIRED_METRICS])
    return F.when(~missing, F.round(F.least(total, F.lit(MAX_SCORE)), 1))
